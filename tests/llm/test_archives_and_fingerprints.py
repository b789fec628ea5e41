"""WARC archives and weighted sampling."""

import collections
import hashlib
import io
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from spanseek.llm import warc, weighted_sampling
from spanseek.staging import new_folder

from .helpers import WORD, empty, odd

PAGES = "page_id long, url string, html string"


def written(spark, rows):
    path = new_folder(spark, "warc-test")
    warc.write(warc.share_payloads(spark.createDataFrame(rows, PAGES), "page_id", "html", "url"), path)
    return path


def test_copies_are_stored_once(spark):
    large, larger = "é" * 500, "x" * 1000
    rows = [(1, "http://a/1", large), (7, "http://a/7", large), (3, None, large), (4, "u", larger), (5, "u", "x" * 999), (6, "u", "x" * 999)]
    rows += [(8, "", None), (9, "a\r\nb: c", ""), (None, "u", larger), (10, "u ", larger)]
    path = written(spark, rows)
    found = {r.record_id: r for r in warc.read(spark, path).collect()}
    assert len(found) == len(rows)
    page = lambda i: found[f"<urn:x-page:{'' if i is None else i}>"]
    kinds = {i: page(i).record_type for i, _, _ in rows}
    assert {i for i, k in kinds.items() if k == "revisit"} == {1, 3, 4, None}
    assert page(None).refers_to == "<urn:x-page:10>"
    assert page(1).refers_to == page(3).refers_to == "<urn:x-page:7>" and page(4).refers_to == "<urn:x-page:10>"
    for i, url, html in rows:
        data = (html or "").encode()
        assert page(i).payload_bytes == len(data) and page(i).payload_sha1 == hashlib.sha1(data).hexdigest()
        assert page(i).payload == (None if kinds[i] == "revisit" else data)
    assert page(8).target_uri is None and page(9).target_uri == "a%0D%0Ab: c".replace(" ", "%20")


def test_rows_without_key(spark):
    one, two, three = "a" * 1500, "b" * 1500, "c" * 1500
    path = written(spark, [(None, "u", one), (5, "u", one), (None, "u", two), (None, "v", two), (9, "u", three), (9, "v", three), (None, "u", three)])
    found = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_sha1) for r in warc.read(spark, path).collect())
    sha = {t: hashlib.sha1(t.encode()).hexdigest() for t in (one, two, three)}
    # One beside a stored row, two without any key, one beside a repeated row.
    expected = [("<urn:x-page:>", "revisit", "<urn:x-page:5>", sha[one]), ("<urn:x-page:5>", "response", "", sha[one])]
    expected += [("<urn:x-page:>", "response", "", sha[two])] * 2
    expected += [("<urn:x-page:9>", "response", "", sha[three])] * 2 + [("<urn:x-page:>", "revisit", "<urn:x-page:9>", sha[three])]
    assert found == sorted(expected)


def test_clashing_names_and_very_long_payloads(spark):
    names = ["stored", "sha1", "n", "least", "body", "key"]
    wide = spark.createDataFrame([(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000)], PAGES)
    wide = wide.select("*", *[F.lit(0).alias(n) for n in names])
    records = warc.share_payloads(wide, "page_id", "html", "url")
    assert sorted(tuple(r) for r in records.select("record_type", "payload_bytes").collect()) == [
        ("response", 6_000_000), ("response", 6_000_000), ("revisit", 6_000_000)
    ]


def test_header_predicates_are_pushed(spark):
    path = written(spark, [(i, f"http://{'ab'[i % 2]}/{i}", "y" * 1500 if i < 4 else "z" * i) for i in range(10)])
    read = warc.read(spark, path)
    kept = read.where("record_type = 'revisit' AND target_uri LIKE 'http://a%'")
    assert sorted(r.record_id for r in kept.collect()) == ["<urn:x-page:0>", "<urn:x-page:2>"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert " Filter (" not in plan
    reader = warc.WarcReader({"path": path})
    # Accepting nothing, the reader inflates no payload.
    reader.tests = [("=", "record_type", "request")]
    assert [b for p in reader.partitions() for b in reader.read(p)] == []
    assert warc.read(spark, path, payload=False).where("payload IS NOT NULL").count() == 0
    assert read.where("content_length >= 1500").count() == 1


def test_partitions_follow_sizes(spark):
    path = written(spark, [(i, "u", "w" * 50) for i in range(40)])
    many = warc.WarcReader({"path": path, "partitionbytes": "1"}).partitions()
    one = warc.WarcReader({"path": path}).partitions()
    assert sorted(n for p in many for n in p.names) == sorted(n for p in one for n in p.names) and len(one) == 1


def test_archives_of_others(spark, tmp_path):
    import gzip

    row = {"record_id": "<urn:x>", "record_type": "response", "target_uri": "http://x", "refers_to": None, "payload_sha1": None, "payload_bytes": None, "payload": b"p" * 20_000}
    long_head = b"WARC/1.1\r\nWARC-Type: metadata\r\nX-Long: " + b"h" * 20_000 + b"\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    records = [warc.record(row, "2020-01-01T00:00:00Z"), long_head, warc.record(row | {"payload": None}, "d")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "c.txt").write_text("not an archive")
    (tmp_path / "d.warc").write_bytes(b"")
    found = warc.read(spark, str(tmp_path)).collect()
    assert sorted(len(r.payload) for r in found) == [0, 0, 3, 3, 20_000, 20_000]
    assert {r.record_type for r in found} == {"response", "metadata"}


def test_members_tell_their_size():
    import gzip

    data = b"record " * 1000
    packed = warc.member(data)
    assert gzip.GzipFile(fileobj=io.BytesIO(packed + packed)).read() == data * 2
    assert warc.Member(memoryview(packed + b"rest")).size() == len(packed)
    with pytest.raises(ValueError):
        warc.Member(memoryview(packed[:20])).rest()


def test_empty_archive(spark):
    assert warc.read(spark, written(spark, [])).count() == 0


# --- weighted sampling ----------------------------------------------------------------


def jaccard(a, b):
    a, b = (collections.Counter(WORD.findall(t)) for t in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collisions_equal_generalised_jaccard(spark):
    pairs = [("a a a b c d", "a b b c e"), ("w x y z", "w x y z z z z"), ("p p p p q", "p q q q q"), ("k l", "m n")]
    rows = [(i, j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    frame = spark.createDataFrame(rows, "i int, j int, text string")
    terms = frame.select("i", "j", weighted_sampling.weights(F.col("text")).alias("terms"))
    found = {(r.i, r.j): r.samples for r in weighted_sampling.fingerprints(terms, "terms", ["i", "j"], 400).collect()}
    for i, (a, b) in enumerate(pairs):
        same = sum(x == y for x, y in zip(found[i, 0], found[i, 1])) / 400
        assert abs(same - jaccard(a, b)) < 0.1, (a, b)


def signed_hash(text):
    return (xxhash.xxh64_intdigest(text.encode(), seed=42) ^ (1 << 63)) - (1 << 63)


def check_compared(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash"))
    found = weighted_sampling.compared(frame).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -signed_hash(r[1] or ""), r[1] or ""))
    expected = []
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        expected.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    return found


def test_edited_texts_of_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    found = check_compared(spark, rows)
    by_length = collections.defaultdict(set)
    for r in found:
        by_length[r.n_chars if r.n_chars else "empty"].add(r.fingerprint)
    assert len(by_length["empty"]) == 1 and len(by_length[43]) == 1
    assert weighted_sampling.compared(empty(spark).select("doc_id", "text")).count() == 0


def test_one_row_goes_on_with_itself(spark):
    (only,) = check_compared(spark, [(5, "abcdef ghi jkl")])
    assert only.near_next == 1


def test_many_buckets_and_code_points(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "BUCKET_BYTES", 1)
    monkeypatch.setattr(weighted_sampling, "CELLS", 4)
    words = ["é🙂 text", "other words here", "", "ß" * 7, "a b c d e f g h i"]
    check_compared(spark, [(i * i, f"{words[i % 5]} {i}") for i in range(60)])


def test_rows_of_one_key_or_none_fill_many_buckets(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} of {i % 11} words") for i in range(900)]
    check_compared(spark, rows)
    monkeypatch.setattr(weighted_sampling, "BUCKET_BYTES", 1)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = sorted(r["count"] for r in weighted_sampling._bucketed(frame, "doc_id", "text").groupBy("bucket").count().collect())
    assert sum(sizes) == 900 and sizes[-1] < 30


def test_likeness_at_the_production_number(spark):
    rng, words = random.Random(4), [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))) for i in range(300)]
    found = {r.doc_id: r for r in weighted_sampling.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    errors = []
    for i, text in rows:
        after = rows[i - 1][1]
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        errors += [found[i].near_edited - jaccard(text, changed), found[i].near_next - jaccard(text, after)]
    bound = 0.5 / weighted_sampling.SAMPLES**0.5
    assert abs(sum(errors) / len(errors)) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < bound and max(map(abs, errors)) < 5 * bound


def test_no_python_on_the_main_path(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for made in (weighted_sampling.edited(frame), weighted_sampling.compared(frame)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
