"""Sharding, token alignment and the filter audit against brute force."""

import collections
import hashlib
import itertools
import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanseek.llm import filter_audit, oracles, queries, sharding, token_alignment
from spanseek.staging import new_folder

from .helpers import DOCS, WORD, documents, empty, odd

SF = "/root/testdata/sf0.01"


# --- sharding ---------------------------------------------------------------------


def check_law(rows, shards):
    """Slots without gaps, and sizes within a hundredth of the mean or the largest row."""
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert set(slots) <= set(range(shards))
    mean = sum(sizes.values()) / shards
    allowed = max(mean / 100, max(r.size for r in rows))
    assert all(abs(sizes[s] - mean) <= allowed for s in range(shards)), (sizes, mean)
    return sizes


def test_shards_are_even_and_keep_equal_texts_together(spark):
    rows = queries.queries()["op11_sharding"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in documents(spark, "sf0.01").collect()}
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    sizes = check_law(rows, 40)
    groups = collections.defaultdict(list)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        groups[data].append(r)
    mean = sum(sizes.values()) / 40
    fitting = [g for g in groups.values() if len(g) > 1 and sum(r.size for r in g) <= mean / 2]
    assert len(fitting) > 40 and sum(len({r.shard for r in g}) > 1 for g in fitting) <= len(fitting) // 20


def test_hot_group_fills_few_shards(spark):
    rng = random.Random(3)
    rows = [(i, "the same text again " * 5) for i in range(1300)]
    rows += [(None, f"text {rng.random()} " * rng.randrange(1, 12)) for _ in range(2700)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    placed = sharding.assign(frame, 20).collect()
    check_law(placed, 20)
    same = collections.Counter(r.shard for r in placed if r.doc_id is not None)
    total = sum(r.size for r in placed)
    needed = sum(r.size for r in placed if r.doc_id is not None) / (total / 20)
    assert len(same) <= needed + 4 and sum(same.values()) == 1300


def test_all_documents_are_copies(spark):
    rows = [(i, f"text number {i % 500} " * (1 + i % 7)) for i in range(3500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("size", F.lit(None))
    placed = sharding.assign(frame, 10).collect()
    check_law(placed, 10)
    spread = collections.defaultdict(set)
    for r in placed:
        spread[r.text_crc32].add(r.shard)
    # The hash alone would spread the seven copies over five shards on average.
    assert np.mean([len(s) for s in spread.values()]) < 1.6


def test_nodes_with_several_hubs_move_together(spark):
    """Two communities of hubs; links across them are few."""
    rng = random.Random(4)
    nodes = [(i, 1, 10, rng.randrange(2)) for i in range(200)]
    links = [(i, f"{i % 2}-{rng.randrange(6)}") for i in range(200) for _ in range(4)]
    frame = spark.createDataFrame(nodes, "node long, n long, bytes long, shard int")
    edges = spark.createDataFrame(links, "node long, hub string").distinct()
    seats = {r.node: r.shard for r in sharding.propagate(frame, edges, 2, 1100).collect()}
    hubs = collections.defaultdict(collections.Counter)
    start = collections.defaultdict(collections.Counter)
    for node, hub in set(links):
        hubs[hub][seats[node]] += 1
        start[hub][nodes[node][3]] += 1

    def joined(counts):
        return sum(n * (n - 1) // 2 for c in counts.values() for s, n in c.items() if s is not None)

    assert joined(hubs) > 1.3 * joined(start)
    assert max(collections.Counter(s for s in seats.values() if s is not None).values()) * 10 <= 1100


def test_quotas_hold():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = 6
        loads = rng.integers(0, 100, n).astype(float)
        asked = rng.random((n, n)) * (loads / n)[:, None]
        np.fill_diagonal(asked, 0)
        capacity = max(loads.mean() * 1.1, 1)
        allowed = sharding.quotas(loads, asked, capacity)
        assert (allowed <= asked.sum(0) + 1e-6).all() and (loads + allowed - asked.sum(1) <= np.maximum(capacity, loads) + 1e-6).all()
    assert sharding.quotas(np.array([5.0, 5.0]), np.array([[0, 5.0], [5.0, 0]]), 5.0).tolist() == [5, 5]
    assert sharding.rooms([1.0, 5.0, 9.0], 6.0) == [5.0, 1.0, 0.0]


def test_sharding_of_odd_and_empty_tables(spark):
    rows = sharding.assign(odd(spark), 3).collect()
    assert collections.Counter(r.doc_id for r in rows) == {1: 3, None: 2, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(16, 0)}
    check_law(rows, 3)
    assert sharding.assign(empty(spark), 3).count() == 0


# --- token alignment ----------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabularies():
    return token_alignment.Tokenizers(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def brute_alignments(texts):
    """Groups per text by sets of ends, without windows or memory."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a = first.encode(" " + text, add_special_tokens=False)
        b = second.encode(text)
        bytes_a = [bytes(letters[c] for c in t) for t in a.tokens]
        bytes_b = [bytes.fromhex(p[3:5]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode() for p in second.id_to_piece(b)]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            out.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, side))) for side in (bytes_a, bytes_b)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], 0
        for end in shared:
            groups.append(
                ([i for i, e in zip(a.ids, ends[0]) if at < e <= end], [i for i, e in zip(b, ends[1]) if at < e <= end])
            )
            at = end
        out.append(groups)
    return out


def brute_rows(texts):
    aligned = brute_alignments(texts)
    held = collections.Counter()
    for groups in aligned:
        held.update({(p, q) for x, y in groups or [] for p in x for q in y})
    top = {}
    for (p, _), n in held.items():
        top[p] = max(top.get(p, 0), n)
    rows = []
    for groups in aligned:
        links = [(p, q) for x, y in groups or [] for p in x for q in y]
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or [])
        rows.append(
            (
                sum(len(x) for x, _ in groups or []),
                sum(len(y) for _, y in groups or []),
                len(groups or []),
                len(links),
                sum(held[link] == top[link[0]] for link in links),
                sum(held[link] for link in links),
                shown,
            )
        )
    return rows


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def short(spark):
    """Documents of sf0.001 up to a length that brute force can bear."""
    return documents(spark).where(F.length("text") < 3000)


def test_alignment_equals_brute_force(spark, vocabularies):
    rows = short(spark).select("doc_id", "text").collect()
    made = token_alignment.align(short(spark), vocabularies, keep=["doc_id"]).collect()
    expected = dict(zip([r.doc_id for r in rows], brute_rows([r.text for r in rows])))
    assert len(made) == len(rows) > 100
    assert {r.doc_id: (*(r[c] for c in COUNTS), r.groups) for r in made} == expected


def test_many_dictionaries_count_alike(spark, vocabularies, monkeypatch):
    once = {r.doc_id: r for r in token_alignment.align(short(spark), vocabularies, keep=["doc_id"]).collect()}
    monkeypatch.setattr(token_alignment, "DICTIONARY_TOKENS", 500)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 1)
    monkeypatch.setattr(token_alignment, "MEMORY", 1000)
    monkeypatch.setattr(token_alignment, "LONG", 1000)
    monkeypatch.setattr(token_alignment.rows, "SLICE", 3)
    again = token_alignment.align(short(spark).repartition(3), vocabularies, keep=["doc_id"]).collect()
    assert {r.doc_id: r for r in again} == once


def test_alignment_query_digests_groups(spark, vocabularies):
    found = {r.doc_id: r for r in queries.queries()["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    for r in token_alignment.align(documents(spark), vocabularies, keep=["doc_id"]).collect():
        assert found[r.doc_id].groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")
        assert found[r.doc_id].count_sum == r.count_sum


HARD = [
    None,
    "",
    " ",
    "   \n\t  ",
    "▁literal mark",
    "<s> </s> <unk> <|endoftext|> <0x41>",
    "é中文🙂 ﬁ １２ \x00 nul",
    "no" * 5000,
    "=" * 3000 + " " * 500,
    "naïve façade — “quoted” text…",
    "same text",
    "same text",
]


def test_hard_texts_and_clashing_columns(spark, vocabularies):
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(HARD)], "doc_id long, text string, groups string, N_A int")
    made = token_alignment.align(frame, vocabularies)
    assert made.columns == ["doc_id", "text", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    got = {r.doc_id: (*(r[c] for c in COUNTS), r.groups) for r in made.collect()}
    assert got == dict(enumerate(brute_rows(HARD)))
    assert got[4] == got[0] == (0, 0, 0, 0, 0, 0, "") and got[5][0] > 0


def test_alignment_of_odd_and_empty_tables(spark, vocabularies):
    made = token_alignment.align(odd(spark), vocabularies, keep=["doc_id"]).collect()
    expected = brute_rows([r.text for r in odd(spark).collect()][:-1])
    assert sorted(r.n_a for r in made)[:-1] == sorted(e[0] for e in expected)
    assert max(made, key=lambda r: r.n_a).n_groups >= 40_000
    assert token_alignment.align(empty(spark), vocabularies).count() == 0


# --- filter audit -------------------------------------------------------------------


def brute_audit(docs, labels):
    good = {k for k, quality, _ in labels if quality == 1}
    toxic = {k for k, _, bad in labels if bad == 1}
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    failing = []
    for key, text, part in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None and least[text] < key,
        }
        failing.append((part or "", key, {f for f, bad in fails.items() if bad}))
    rows = {}
    for part in {p for p, _, _ in failing}:
        mine = [(k, f) for p, k, f in failing if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(k, f) for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                fail = sum(letter in f for _, f in mine)
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    fail - len(gone),
                    sum(f == {letter} for _, f in mine),
                    sum(k in good for k, _ in gone),
                    sum(k in toxic for k, _ in gone),
                ]
    share = collections.Counter()
    for (part, order, step), row in rows.items():
        share[part, order[step - 1]] += row[1]
    return {k: (*row, share[k[0], k[1][k[2] - 1]]) for k, row in rows.items()}


def collected(frame):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in frame.collect()}


def in_files(spark, docs, n, schema="doc_id long, text string, source string"):
    """A folder of ``n`` files, written in the order of ``docs``."""
    folder = new_folder(spark, "docs")
    size = -(-len(docs) // n)
    for i in range(0, max(len(docs), 1), max(size, 1)):
        spark.createDataFrame(docs[i : i + size], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


LABELS = "doc_id long, quality int, toxic int"


def test_audit_query_equals_sql(spark):
    found = queries.queries()["op13_filter_audit"](spark, SF)
    with duckdb.connect() as db:
        for name in ("documents", "labels"):
            db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
        names = ", ".join(found.columns)
        expected = db.sql(f"SELECT {names} FROM ({oracles.op13_filter_audit()})").fetchall()
    assert collected(found) == {tuple(r[:3]): tuple(r[3:]) for r in expected}


def test_smaller_ids_retract_what_was_counted(spark):
    """Ids arrive in descending order, one file each micro-batch."""
    rng = random.Random(6)
    texts = ["alpha " * 300, "Some NEW text", "price: 5$ " * 90, None, "", " ".join(f"w{i}" for i in range(400))]
    docs = [(900 - i, rng.choice(texts), rng.choice(["a", "b", None])) for i in range(120)]
    labels = [(900 - i, rng.randrange(2), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(900, 1, 1), (None, 1, 1)]
    path = in_files(spark, docs, 6)
    made = filter_audit.audit(spark, path, spark.createDataFrame(labels, LABELS), batches=6)
    assert collected(made) == brute_audit(docs, labels)


def test_a_second_run_takes_up_new_files_only(spark):
    docs = [(50 - i, f"text {i % 7}", "s") for i in range(40)]
    labels = spark.createDataFrame([(11, 1, 1)], LABELS)
    path, folder = in_files(spark, docs[:20], 2), new_folder(spark, "audit")
    filter_audit.run(spark, path, labels, folder, 1, 5)
    spark.createDataFrame(docs[20:], "doc_id long, text string, source string").write.mode("append").parquet(path)
    counters = filter_audit.run(spark, path, labels, folder, 1, 5)
    assert collected(filter_audit.report(counters, "ABCDE")) == brute_audit(docs, [(11, 1, 1)])
    assert len([f for f in os.listdir(f"{folder.removeprefix('file:')}/checkpoint/commits") if f.isdigit()]) >= 3


def test_audit_of_odd_and_empty_tables(spark):
    docs = [(r.doc_id, r.text, r.source) for r in odd(spark).collect()] * 2
    labels = [(1, 1, None), (1, 0, 1), (2, None, None), (3, 1, 1)]
    path = new_folder(spark, "docs")
    spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, source string, mask string, salt int").write.parquet(path)
    made = filter_audit.audit(spark, path, spark.createDataFrame(labels, LABELS), batches=3)
    assert collected(made) == brute_audit(docs, labels)
    none = new_folder(spark, "docs")
    spark.createDataFrame([], DOCS).coalesce(1).write.parquet(none)
    assert filter_audit.audit(spark, none, spark.createDataFrame([], LABELS)).count() == 0


def test_state_of_a_text_does_not_depend_on_the_order():
    facts = [["a", 1, 0, 3, 5, 1, 2], ["b", 0, 0, 2, 5, 2, 0], ["a", 0, 0, 1, 9, 1, 0], ["c", 0, 1, 4, 2, 1, 0], ["c", 0, 0, 0, None, 0, 3]]
    results = set()
    for order in itertools.permutations(facts):
        known, total = (None, []), collections.Counter()
        for fact in order:
            known, changes = filter_audit.retract(known, [fact], 16)
            for *counter, n in changes:
                total[tuple(counter)] += n
        results.add((known[0], frozenset((c, n) for c, n in total.items() if n)))
    assert len(results) == 1
