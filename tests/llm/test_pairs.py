"""SimHash, components and substring removal against brute force."""

import collections
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from spanseek.llm import simhash, substring_dedup
from spanseek.llm.components import connected
from spanseek.llm.queries import queries

from .helpers import WORD, documents, empty, odd


def union_find(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    pairs = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + chain + star + [(7, 7), (9, 8), (8, 9), (None, 3)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    expected = union_find(real, {x for p in real for x in p})
    assert {r.node: r.root for r in connected(frame).collect()} == expected
    assert connected(frame.where("a = 7")).count() == 0


def brute_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    found = queries()["op4_simhash"](spark, "/root/testdata/sf0.001").collect()
    prints = {r.doc_id: brute_print(r.text) for r in documents(spark).collect()}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in found) and len(found) == len(prints)
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id: r.component_id for r in found} == union_find(pairs, ids)


def test_spark_and_python_hash_shingles_alike(spark):
    row = spark.sql("SELECT xxhash64('a b ç') AS h").first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def test_all_links_are_found_once(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    # One dense ball, so that postings exceed the pairwise bound, and scattered numbers.
    prints = {base} | {base ^ (rng.getrandbits(16) << 48) for _ in range(400)}
    prints |= {base ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(64)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed + signed[:50]], "fp long")
    for distance in (0, 1, 2, 3):
        expected = {
            frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= distance
        }
        found = [frozenset((r.a, r.b)) for r in simhash.links(frame, distance).collect()]
        assert set(found) == expected and len(found) == len(expected)


def test_simhash_of_odd_rows(spark):
    rows = simhash.near_duplicates(odd(spark)).collect()
    assert len(rows) == 10
    blank = [r for r in rows if r.fp == 0]
    assert sorted(str(r.doc_id) for r in blank) == ["2", "3", "4", "None"] and {r.component_id for r in blank} == {2}
    alone = [r for r in rows if r.doc_id is None and r.fp != 0]
    assert [r.component_id for r in alone] == [None]
    kept = simhash.keep_first(odd(spark).withColumn("fp", F.lit(1)))
    assert kept.count() == 6 and kept.columns[-1] == "fp"
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(empty(spark)).count() == 0


def brute_removal(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for own in words:
        gone = set()
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def check_removal(spark, texts, window, gram, hot):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = substring_dedup.remove_repeats(frame, window=window, gram=gram, hot=hot).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in found] == brute_removal(texts, window)


def test_removal_equals_brute_force(spark):
    rng = random.Random(3)
    common = " ".join(rng.choice("abcdef") for _ in range(9))
    texts = [None, "", "a", " a\tb\x0b c\n" * 5, "x " * 50]
    for _ in range(60):
        own = [rng.choice("abcdefghijklmn") for _ in range(rng.randrange(60))]
        texts.append(" ".join(own[:10]) + " " + common + "  " + " ".join(own[10:]))
    texts += texts[10:14] * 3
    for window, gram, hot in ((6, 2, 10_000), (6, 2, 1), (4, 4, 3), (5, 1, 2), (12, 3, 10)):
        check_removal(spark, texts, window, gram, hot)


def test_repeats_do_not_grow_lists(spark):
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text)] * 5000 + [(2, "x " * 1_000_000), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    keyed = substring_dedup._keyed(frame, "doc_id", "text")
    found = substring_dedup.occurrences(keyed.where("id = 2"), 35, 5)
    assert found.count() < 10 and found.selectExpr("sum(size(starts))").first()[0] > 100_000
    ranges = substring_dedup.repeated_ranges(keyed)
    few = spark.createDataFrame([(1, text)] * 2, "doc_id long, text string")
    size = substring_dedup.repeated_ranges(substring_dedup._keyed(few, "doc_id", "text")).selectExpr("size(ranges)").first()[0]
    assert size == ranges.where("k1 = 1").selectExpr("size(ranges)").first()[0]
    kept = substring_dedup.remove_repeats(frame).groupBy("doc_id", "n_words", "n_removed", "kept").count().collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept, r["count"]) for r in kept) == [
        (1, 120, 120, "", 5000), (2, 1_000_000, 1_000_000, "", 1), (3, 0, 0, "", 1)
    ]


def test_removal_over_place_blocks(spark, monkeypatch):
    rng = random.Random(4)
    words = [rng.choice("abc") for _ in range(400)]
    monkeypatch.setattr(substring_dedup, "_PLACE_BITS", 5)
    cut = substring_dedup.SuperKmers(6, 2)
    owner, m, f, s, c = cut([" ".join(words), "", "a b c a b c a"])
    assert c.sum() == 395 + 2 and (np.bincount(owner, c) == [395, 0, 2]).all()


def test_removal_of_odd_rows(spark):
    rows = substring_dedup.remove_repeats(odd(spark).withColumn("k1", F.lit(0)), window=4, gram=2).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in rows)
    texts = [(r.doc_id, r.text) for r in odd(spark).collect()]
    expected = brute_removal([t for _, t in texts], 4)
    assert found == sorted((str(i), *e) for (i, _), e in zip(texts, expected))
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    strings = odd(spark).withColumn("doc_id", F.col("doc_id").cast("string"))
    assert substring_dedup.remove_repeats(strings, window=4, gram=2).count() == 10


def test_equal_numbers_are_compared_by_words(monkeypatch):
    bucket = substring_dedup._Bucket(2)
    monkeypatch.setattr(bucket, "_runs", lambda words, a, b: np.zeros(a.size, np.uint64))
    assert bucket([b"a b c", b"x a b"], [1, 1]) == [[0, 1], [1, 2]]
    assert bucket([b"a b c", b"x y z"], [1, 2]) == [[], [0, 2]]


def test_texts_of_one_key_with_equal_32_bit_hashes_are_told_apart(spark):
    # Some of these 400,000 texts agree in Spark's 32-bit hash; null keys do not tell them apart.
    text = F.concat(F.expr("repeat('x ', cast(id % 7 AS int))"), F.lit("t"), F.col("id"), F.lit(" a b c d e"), F.col("id") % 5)
    texts = spark.range(400_000).select("id", text.alias("text"), F.hash(text).alias("h"))
    alike = texts.join(texts.groupBy("h").count().where("count > 1"), "h").orderBy("h", "id")
    picked = [r.text for r in alike.collect()]
    assert len(picked) > 2
    frame = spark.createDataFrame([(None, t) for t in picked], "doc_id long, text string")
    keyed = substring_dedup._keyed(frame, "doc_id", "text")
    assert keyed.select("k1", "k2").distinct().count() == len(picked)
    found = substring_dedup.remove_repeats(frame, window=4, gram=2).collect()
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found) == sorted(brute_removal(picked, 4))
