"""Toxicity, perplexity and decontamination."""

import collections
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanseek.llm import decontaminate, perplexity, toxicity
from spanseek.llm.queries import held_out, queries, table

from .helpers import documents, empty, odd

SF = "/root/testdata/sf0.01"


# --- toxicity ---------------------------------------------------------------------


decoder_words = []


@pytest.fixture(scope="module")
def decoder(spark):
    decoder_words[:] = [r.text.lower() for r in documents(spark, "sf0.001").select("text").collect() if r.text]
    return toxicity.Decoder(toxicity.log_probabilities(toxicity.count_trigrams(documents(spark, "sf0.01"), "text")))


def test_disguises_are_undone(decoder):
    cases = {"1d10t": "idiot", "s t u p i d": "stupid", "p.a.t.h.e.t.i.c": "pathetic", "$tup1d": "stupid"}
    cases |= {"stuuuupid": "stupid", "clooown": "clown", "w0rthl3ss": "worthless", "Idiotttt!!!": "idiot!!!"}
    for written, meant in cases.items():
        assert decoder.restore(f"the {written} and") == f"the {meant} and"
    mixed = {"d i e": "die", "1 d 1 0 t": "idiot", "i d 1 0 t": "idiot", "stuupid": "stupid", "iidiott": "idiot"}
    mixed |= {"s.t.u.p.1.d": "stupid", "id1o+": "idiot", "1d10+": "idiot"}
    for written, meant in mixed.items():
        assert decoder.restore(f"the {written} and") == f"the {meant} and"
    for plain in ("192.168.1.1", "of%%% the&&& an***", "a b c", "", "well, 3 of 10", "2.0", "erster$$$ and", "x = 3 + y"):
        assert decoder.restore(plain) == plain


def test_runs_of_signs_stand_and_cost_little(decoder):
    for plain in ("a" + "*" * 10_000, "b" + "$" * 500 + "c", "x" + "*1" * 5_000, "a_" + "1" * 300 + "b"):
        started = time.perf_counter()
        assert decoder.restore(plain) == plain
        assert time.perf_counter() - started < 1


def test_doubled_letters_by_table_and_by_search_agree(decoder):
    words = {w for r in decoder_words for w in r.split() if w.isalpha() and w.isascii()}
    lone = [w for w in sorted(words) if sum(a == b for a, b in zip(w, w[1:])) == 1][:300]
    assert len(lone) > 50
    for word in [*lone, "stuupid", "idiott", "iidiot"]:
        assert decoder.restore(word) == decoder.decode(word), word


def test_weights_and_scores_equal_brute_force(spark):
    labels = spark.range(60).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS toxic")
    text = "if(toxic = 1, concat('vile m0nster n', doc_id % 4), concat('pleasant day n', doc_id % 4))"
    docs = labels.selectExpr("doc_id", f"{text} AS text")
    model = toxicity.train(docs, labels, F.lit(True), F.col("doc_id") % 2 == 0)
    undo = toxicity.Decoder(model.characters).restore
    given = [(undo(r.text), r.toxic, r.doc_id) for r in docs.join(labels, "doc_id").collect()]
    learnt = [(t, y) for t, y, i in given if i % 2]

    def units(text):
        words = re.findall("[a-z]+", text)
        return [{w, *((w[:n], n) for n in toxicity.PREFIXES if len(w) > n)} for w in words]

    seen = collections.Counter(y for _, y in learnt)
    counts = collections.Counter((u, y) for t, y in learnt for u in set().union(*units(t)))

    def weight(u):
        a, b = counts[u, 1] + 0.5, counts[u, 0] + 0.5
        odds = math.log(a / (seen[1] + 1)) - math.log(b / (seen[0] + 1)) - math.sqrt(1 / a + 1 / b)
        return odds if odds >= toxicity.LEAST_WEIGHT else 0.0

    def measured(text):
        own = [max([0.0, *map(weight, u)]) for u in units(text)]
        return [math.log1p(sum(own)), math.log1p(1000 * sum(own) / len(own)), 1.0]

    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for t, _, i in given:
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-np.dot(measured(t), model.logistic))), rel=1e-4)


def test_one_part_without_a_label_still_teaches(spark):
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    docs = labels.selectExpr("doc_id", "if(toxic = 1, 'you horrible m0nster here', 'such a pleasant day') AS text")
    for hold in (F.col("doc_id") % 2 == 0, F.lit(False), F.lit(True)):
        model = toxicity.train(docs, labels, F.lit(True), hold)
        scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        assert all((s > 0.5) == (i % 2 == 1) for i, s in scores.items())


def test_decoder_finds_the_best_path(decoder):
    def best(token):
        paths = [("", 0.0)]
        for options in toxicity.lattice(token):
            paths = [(text + meant, score + cost) for text, score in paths for meant, cost in options]

        def language(text):
            s = [0, 0, *map(toxicity.symbol, text), 0]
            return sum(decoder._model[a, b, c] for a, b, c in zip(s, s[1:], s[2:]))

        return max(score + language(text) for text, score in paths), {text for text, _ in paths}, paths, language

    for token in ("1d10t", "h8", "a.b-c", "l00ose", "b@dd"):
        top, readings, paths, language = best(token)
        found = decoder.decode(token)
        assert math.isclose(max(s + language(t) for t, s in paths if t == found), top, abs_tol=1e-9)


def test_trigram_counts_grow_with_the_corpus_and_equal_brute_force(spark):
    docs = spark.createDataFrame([("ab b",), (None,), ("",), ("ab",)], "text string")
    counts = toxicity.count_trigrams(docs, "text")
    expected = collections.Counter()
    for text in ("ab b", "ab"):
        s = [0, *map(toxicity.symbol, text), 0]
        expected.update(zip(s, s[1:], s[2:]))
    assert {k: counts[k] for k in expected} == expected and counts.sum() == sum(expected.values())
    twice = toxicity.count_trigrams(docs.union(docs), "text")
    assert (twice == 2 * counts).all()
    assert np.allclose(np.exp(toxicity.log_probabilities(counts)).sum(axis=2), 1)


def test_toxic_documents_are_told_apart(spark):
    rows = queries()["op1_toxicity"](spark, SF).collect()
    truth = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(truth[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in truth]
    pairs = [(a > b) + 0.5 * (a == b) for x, a in held if x for y, b in held if not y]
    assert len(held) > 50 and np.mean(pairs) > 0.75


def test_toxicity_of_odd_rows(spark):
    nobody = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    every = F.lit(True)
    assert toxicity.train(odd(spark), nobody, every, held_out("doc_id", 5, 4)) is None
    assert toxicity.train(empty(spark), nobody.where("false"), every, held_out("doc_id", 5, 4)) is None
    clash = odd(spark).withColumn("score", F.lit("x"))
    assert [r.score for r in toxicity.score(clash, None).collect()] == [0.0] * 10
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    docs = labels.selectExpr("doc_id", "if(toxic = 1, 'you horrible m0nster here', 'such a pleasant day') AS text")
    model = toxicity.train(docs, labels, every, held_out("doc_id", 5, 4))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((s > 0.5) == (i % 2 == 1) for i, s in scores.items())
    rest = toxicity.score(odd(spark), model).collect()
    assert len(rest) == 10 and len({r.score for r in rest if not (r.text or "").strip()}) == 1
    assert toxicity.restore(odd(spark), model).count() == 10


# --- perplexity --------------------------------------------------------------------


def brute_kneser_ney(texts):
    """Interpolated modified Kneser-Ney, straight from its definition: the probability of an n-gram's last character."""
    n = perplexity.ORDER
    tables = {k: collections.Counter() for k in range(1, n + 1)}
    for text in texts:
        s = perplexity.START * (n - 1) + text + perplexity.END
        tables[n].update(s[i : i + n] for i in range(len(s) - n + 1))
    for k in range(n - 1, 0, -1):
        tables[k].update(g[1:] for g in tables[k + 1])
    cut = {k: perplexity.discounts(*(sum(c == i for c in tables[k].values()) for i in (1, 2, 3, 4))) for k in tables}
    size = len(tables[1]) + 1

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / size
        below = p(gram[1:])
        same = [c for g, c in tables[k].items() if g[:-1] == gram[:-1]]
        if not same:
            return below
        d = cut[k]
        c = tables[k][gram]
        freed = sum(d[min(x, 3) - 1] for x in same)
        return (c - (d[min(c, 3) - 1] if c else 0)) / sum(same) + freed / sum(same) * below

    return p


def brute_perplexity(p, text):
    n = perplexity.ORDER
    s = perplexity.START * (n - 1) + text + perplexity.END
    return math.exp(-sum(math.log(p(s[i : i + n])) for i in range(len(text) + 1)) / (len(text) + 1))


SCRIPTS = ["кошка сидела на ковре", "кот и кошка", "猫坐在垫子上。猫在那里", "ἡ γάτα κάθεται", "😀😀 ok 😀", "قطة على"]
SEEN = ["the cat sat on the mat.", "a cat, the hat!", "THE 3 hats", "éa ñu the the", *SCRIPTS]


def test_perplexity_equals_definition(spark):
    docs = spark.createDataFrame([(t,) for t in [*SEEN, None, ""] + ["abab"] * 3], "text string")
    model = perplexity.train(docs)
    p = brute_kneser_ney([*SEEN] + ["abab"] * 3)
    asked = [*SEEN, "the cats ate 3 hats, ÉA.", "кошки на ковре", "猫在垫子上", "zzz ЖЖ 犬", "x", "a\0b\n", None, ""]
    rows = perplexity.perplexity(spark.createDataFrame(list(enumerate(asked)), "i int, text string"), model).collect()
    assert len(rows) == len(asked)
    for r in rows:
        assert r.text == asked[r.i]
        if r.text:
            assert math.isclose(r.perplexity, brute_perplexity(p, r.text), rel_tol=1e-4), r.text
        else:
            assert r.perplexity is None


def test_model_grows_with_letters_and_text(spark):
    def weights(texts):
        return perplexity.train(spark.createDataFrame([(t,) for t in texts], "text string")).weights

    few, many = weights(["abcabc"] * 3), weights([chr(0x4E00 + i) + chr(0x400 + i % 200) for i in range(2000)])
    assert many.where(F.length("gram") == 1).count() >= 2200 > 10 >= few.where(F.length("gram") == 1).count()


def test_pieces_blocks_and_shards_do_not_change_figures(spark, monkeypatch):
    texts = [f"{w} the cat sat on mat {i % 7}" * (1 + i % 3) for i, w in enumerate(SEEN * 300)]
    texts[5] = "the cat sat on the mat. " * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    model = perplexity.train(docs.limit(50))
    whole = {r.i: r.perplexity for r in perplexity.perplexity(docs, model).collect()}
    monkeypatch.setattr(perplexity, "PIECE", 37)
    monkeypatch.setattr(perplexity, "_HELD", 2_000)
    monkeypatch.setattr(perplexity, "_SHARD_ROWS", 50)
    parts = {r.i: r.perplexity for r in perplexity.perplexity(docs, model).collect()}
    assert len(whole) == len(texts) and parts == whole
    by_text = collections.defaultdict(set)
    for i, t in enumerate(texts):
        by_text[t].add(whole[i])
    assert all(len(found) == 1 for found in by_text.values())


def test_parts_and_answers_equal_a_dictionary():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é猫") for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    weights = collections.Counter()
    for text in texts[:20]:
        weights.update({text[i : i + k]: rng.randrange(-9, 9) for k in (1, 2, 3, 4) for i in range(len(text) - k + 1)})
    table = {}
    for gram, weight in weights.items():
        (found,) = perplexity.hashes(perplexity.points_of([gram]), np.array([len(gram) - 1]), [len(gram)])
        table[int(found[0]) >> 10] = weight
    known = np.array(sorted(table), np.uint64)
    whole = np.array([float(table[int(k)]) for k in known])
    sums, covered = np.zeros(1024), np.zeros(1024)
    for _, part in perplexity.parts_of([p for t in texts for p in perplexity.pieces(t)], list(range(7, 47)), 2):
        docs, total, n = perplexity.unpack(perplexity.answer(part, known, whole), perplexity._ANSWER)
        sums[docs] += total
        covered[docs] += n
    for i, text in enumerate(texts):
        s = perplexity.START * 3 + text + perplexity.END
        expected = sum(weights.get(s[at - k : at], 0) for at in range(4, len(s) + 1) for k in (1, 2, 3, 4))
        assert (sums[i + 7], covered[i + 7]) == (expected, len(text) + 1)


def test_thresholds_are_exact_quantiles(spark):
    rows = [("en", float(i)) for i in range(1, 101)] + [("de", 5.0), (None, 7.0), ("de", None)]
    frame = spark.createDataFrame(rows, "lang string, perplexity double")
    found = {r.lang: r.threshold for r in perplexity.thresholds(frame, "lang", 0.9).collect()}
    assert math.isclose(found["en"], 90, rel_tol=2e-3) and math.isclose(found["de"], 5, rel_tol=2e-3)
    assert set(found) == {"en", "de", None}


def test_junk_is_told_from_good_text(spark):
    rows = queries()["op5_perplexity"](spark, SF).collect()
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert len(rows) == 1000
    kept = {q: np.mean([r.keep for r in rows if quality.get(r.doc_id) == q]) for q in (0, 1)}
    assert kept[1] > 0.95 and kept[0] < 0.2


def test_perplexity_of_odd_rows(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    rows = perplexity.classify(odd(spark), nobody).collect()
    assert len(rows) == 10 and all(r.keep == (r.perplexity is not None) for r in rows)
    clash = odd(spark).withColumn("perplexity", F.lit("x")).withColumn("apart", F.lit(1))
    some = spark.createDataFrame([(1,), (1,), (6,), (None,)], "doc_id long")
    rows = perplexity.classify(clash, some).collect()
    assert len(rows) == 10 and sum(r.perplexity is None for r in rows) == 3
    assert perplexity.classify(empty(spark), nobody).count() == 0


# --- decontamination ---------------------------------------------------------------


def brute_distance(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, q in enumerate(pattern):
            new.append(min(row[i] + (q != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_edit_search_equals_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 90)))
        distance, end = decontaminate.edit_search(pattern, text)
        assert distance == brute_distance(pattern, text)
        assert brute_distance(pattern, text[:end]) == distance


def edited(rng, text, share):
    out = list(text)
    for _ in range(int(share * len(text))):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.34:
            out[at] = rng.choice("abcdefgh ")
        elif kind < 0.67:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdefgh"))
    return "".join(out)


def test_recall_of_edited_items(spark):
    rng = random.Random(7)
    texts = [r.text for r in documents(spark, "sf0.01").limit(100).collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for share, least in ((0.0, 1.0), (0.03, 0.97), (0.06, 0.95)):
        rows, truth = [], set()
        for i in range(100):
            item, text = rng.choice(items)
            base = texts[i]
            rows.append((i, f"{base[: len(base) // 2]} {edited(rng, text.upper() if i % 2 else text, share)}\n{base[len(base) // 2 :]}"))
            truth.add((i, item))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, table(spark, SF, "benchmark")).collect()}
        assert len(found & truth) >= least * 100


def test_found_places_are_within_the_distance(spark):
    docs, items = documents(spark, "sf0.01"), table(spark, SF, "benchmark")
    texts = {r.doc_id: " ".join(decontaminate.normalise(r.text)) for r in docs.collect()}
    asked = {r.item_id: " ".join(decontaminate.normalise(r.text)) for r in items.collect()}
    rows = decontaminate.find(docs, items).collect()
    exact = {(d, i) for d, t in texts.items() for i, a in asked.items() if a in t}
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        assert r.distance <= 0.2 * len(asked[r.item_id])
        assert brute_distance(asked[r.item_id], texts[r.doc_id][r.start : r.end]) == r.distance
    blocks = decontaminate.find(docs, items, block_items=13).collect()
    assert sorted((r.doc_id, r.item_id, r.start) for r in blocks) == sorted((r.doc_id, r.item_id, r.start) for r in rows)
    marked = decontaminate.mark(docs, items, "hits", block_items=13).where("hits > 0")
    assert {r.doc_id for r in marked.collect()} == {r.doc_id for r in rows}


def test_short_and_odd_items(spark):
    items = spark.createDataFrame(
        [(1, "lazy"), (2, None), (3, ""), (4, " \n"), (5, "ox"), (6, "The QUICK brown"), (7, "é🙂 word")], "item_id long, text string"
    )
    rows = decontaminate.find(odd(spark).withColumn("item_id", F.lit(0)), items).collect()
    found = collections.Counter((r.doc_id, r.item_id) for r in rows)
    assert found[1, 1] == 2 and found[1, 6] == 2 and {i for _, i in found} <= {1, 5, 6}
    assert decontaminate.find(empty(spark), items).count() == 0
    assert decontaminate.find(odd(spark), items.where("false")).count() == 0
    assert decontaminate.mark(odd(spark), items, "n_chars").count() == 10


def test_repetitions_reach_the_recall():
    n = decontaminate.repetitions(0.9, 0.85, 10)
    assert 1 - (1 - 0.85**10) ** n >= 0.9 > 1 - (1 - 0.85**10) ** (n - 1)


def test_recall_up_to_the_limit_in_each_length_class(spark):
    """Items of every length class, also of fewer than 64 characters, with as many edits as still count."""
    texts = [r.text for r in documents(spark, "sf0.01").limit(100).collect()]
    whole = [decontaminate.normalise(r.text) for r in table(spark, SF, "benchmark").collect()]
    for size in (300, 100, 70, 50, 30):
        items = []
        for n, words in enumerate(whole):
            while len(words) > 1 and len(" ".join(words)) > size:
                words = words[:-1]
            items.append((n, words))
        index = decontaminate.Index(items, decontaminate.SHARE)
        for share in (0.10, 0.15, 0.20):
            rng, hits = random.Random(size), 0
            for i, text in enumerate(texts):
                n = i % len(items)
                part = [f"{text[:150]} {edited(rng, ' '.join(items[n][1]), share)} {text[150:300]}"]
                hits += any(f[1] == n for f in decontaminate.search_texts(index, [decontaminate.normalise(t) for t in part]))
            assert hits >= 90, (size, share, hits)


def plain_keys(walk, data, start):
    """The bytes sampled by a walk of single steps and the last place read."""
    seen, at = [], start
    for j in range(walk.samples[-1] + 1):
        if j in walk.samples:
            seen.append(data[at])
        if j < walk.samples[-1]:
            at += int(walk.moves[data[at]]) >> j & 1
    return bytes(seen), at


def test_walks_end_early_and_lose_no_candidate(spark):
    """Windows that no item begins like are left out of the later steps; the candidates are those of whole walks."""
    items = [(n, decontaminate.normalise(r.text)) for n, r in enumerate(table(spark, SF, "benchmark").collect())]
    items += [(n + 1000, words[:size]) for n, words in items[:20] for size in (1, 2, 4, 7, 12)]
    index = decontaminate.Index(items, decontaminate.SHARE)
    strings = [" ".join(decontaminate.normalise(r.text))[:1500] for r in documents(spark, "sf0.01").limit(30).collect()]
    strings += [f"{items[n][1][0]} {' '.join(items[n][1])}" for n in range(10)]
    encoded = b"\0".join([*(s.encode() for s in strings), b""])
    data = np.frombuffer(encoded, np.uint8)
    starts = np.array([i for i in range(data.size) if data[i] not in (0, 32) and (i == 0 or data[i - 1] in (0, 32))])
    texts = [" ".join(words).encode() for _, words in items]
    steps, walked = collections.Counter(), collections.Counter()
    for (walk, hints, *_), found in zip(index.tables, decontaminate.candidates(index, data, starts), strict=True):
        size = next(c for c in decontaminate.CLASSES if c[2] == len(walk.samples))
        known = {}
        for n, (text, (_, words)) in enumerate(zip(texts, items)):
            if next(c for c in decontaminate.CLASSES if len(text) >= c[0]) == size:
                place = offset = 0
                for word in words:
                    key, last = plain_keys(walk, text + b"\0", place)
                    if last < len(text):
                        known.setdefault(key, []).append((n, offset))
                    place, offset = place + len(word.encode()) + 1, offset + len(word) + 1
        plain = {(w, *hit) for w, at in enumerate(starts.tolist()) for hit in known.get(plain_keys(walk, encoded, at)[0], ())}
        assert plain == set(zip(*(x.tolist() for x in found)))
        left, before = starts.size, 0
        for n, near, *_ in walk.walk(decontaminate._pairs(data), starts, hints):
            walked[size] += left * (n + 1 - before)
            left, before = near.size, n + 1
        steps[size] += starts.size * len(walk)
    assert walked[decontaminate.CLASSES[0]] < 0.6 * steps[decontaminate.CLASSES[0]]


def test_distances_of_parts_equal_brute_force():
    rng = random.Random(8)
    items = [(n, ["".join(rng.choice("abcé") for _ in range(size))]) for n, size in enumerate((1, 5, 40, 63, 64, 65, 130, 200))]
    index = decontaminate.Index(items, decontaminate.SHARE)
    text = "".join(rng.choice("abcé") for _ in range(400))
    rows = [(n, b, first, first + size) for n, (_, (word,)) in enumerate(items) for b in range(0, len(word), 64) for first, size in ((0, 150), (70, 90), (300, 7), (20, 0))]
    rows.sort(key=lambda r: r[2] - r[3])
    item, begin, first, last = (np.array(x) for x in zip(*rows))
    found = decontaminate._part_distances(index, item, begin, decontaminate._folded(text), first, last)
    for (n, b, low, high), distance in zip(rows, found.tolist()):
        part = items[n][1][0][b : b + 64]
        assert brute_distance(part, text[low : high + 15]) <= distance <= brute_distance(part, text[low:high])
