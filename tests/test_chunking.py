import random

import pytest

from spanseek.operators import chunking


def spans(spark, path, text, size, **options):
    docs = spark.createDataFrame([(path, text)], "file_path string, text string")
    found = chunking.chunk_documents(docs, size, **options).collect()
    assert all(text[r[1] : r[2]] == r[3] for r in found)
    return sorted((r[1], r[2]) for r in found)


def test_short_text_is_one_chunk(spark):
    assert spans(spark, "a.py", "x = 1\n", 150) == [(0, 6)]


def test_early_strong_separator_blocks_weak_one(spark):
    text = "a" * 20 + "\ndef f" + "b" * 120 + "\n" + "c" * 100
    assert spans(spark, "a.py", text, 150)[0] == (0, 150)
    # Without the strong one the late line break is taken.
    assert spans(spark, "a.py", text.replace("\ndef ", "_def "), 150)[0] == (0, 147)


def test_threshold_is_strict(spark):
    at_limit = "a" * (160 - 5) + "\ndef " + "b" * 200
    assert spans(spark, "a.py", at_limit, 200)[0] == (0, 200)
    assert spans(spark, "a.py", "a" + at_limit, 200)[0] == (0, 161)


def test_separators_go_by_list_order(spark):
    # "\ndef " is tried before "\nclass ", although the class comes later.
    text = "a" * 165 + "\ndef f\nclass C" + "b" * 200
    assert spans(spark, "x.PY", text, 200)[0] == (0, 170)


def test_heading_cut_is_inside_the_marks(spark):
    text = "a" * 170 + "\n## title" + "b" * 200
    first, second = spans(spark, "a.md", text, 200)[:2]
    assert first == (0, 172) and text[second[0]] == "#"


def test_plain_text_falls_back_to_sentences(spark):
    text = "a" * 185 + ". " + "b" * 200
    assert spans(spark, "LICENSE", text, 200)[0] == (0, 187)
    assert spans(spark, "notes.txt", text, 200)[0] == (0, 187)


def test_blank_chunk_is_dropped_and_offsets_advance(spark):
    text = "a" * 150 + " " * 150 + "b" * 10
    assert spans(spark, "a.py", text, 150) == [(0, 150), (300, 310)]
    assert spans(spark, "a.py", text, 150, drop_blank=False) == [(0, 150), (150, 300), (300, 310)]


def test_offsets_count_code_points(spark):
    text = "é😀" * 100
    assert spans(spark, "a.py", text, 150) == [(0, 150), (150, 200)]


@pytest.mark.parametrize("suffix", [".py", ".md", ""])
def test_chunks_tile_the_text(spark, suffix):
    rng = random.Random(suffix)
    pieces = ["\n", "\n\n", ". ", "; ", "\ndef f", "\nclass C", "\n#", "word ", "x" * 37, " " * 40, "é"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 300))) for _ in range(60)]
    docs = spark.createDataFrame(
        [(f"{i}{suffix}", t) for i, t in enumerate(texts)], "file_path string, text string"
    )
    size = 177
    by_file = {}
    for r in chunking.chunk_documents(docs, size, drop_blank=False).collect():
        by_file.setdefault(r[0], []).append((r[1], r[2]))
    for i, text in enumerate(texts):
        cuts = sorted(by_file[f"{i}{suffix}"])
        assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
        assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
        assert all(b - a <= size for a, b in cuts)
        assert all(b - a > 0.8 * size for a, b in cuts[:-1])


def test_output_batches_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(chunking, "_BATCH_CHARS", 1000)
    assert spans(spark, "a.py", "x" * 5000, 150)[-1] == (4950, 5000)


def test_decode(spark, rows):
    files = spark.createDataFrame(
        [
            ("bad.py", bytearray(b"bad \xff\xfe")),
            ("empty.py", bytearray(b"")),
            ("ok.md", bytearray("a\r\nb\rcé".encode())),
        ],
        "path string, content binary",
    )
    assert rows(chunking.decode_text(files)) == [("ok.md", ".md", "a\nb\ncé")]


def test_extension_filter_is_exact(spark, rows):
    docs = spark.createDataFrame([("x.PY", ".PY"), ("x.py", ".py"), ("x", "")], "file_path string, ext string")
    assert rows(chunking.filter_extensions(docs), "file_path") == [("x",), ("x.py",)]


@pytest.mark.parametrize("size", [150, "2000", 777])
def test_chunk_size_accepted(size):
    assert chunking.validate_chunk_size(size) == int(size)


@pytest.mark.parametrize("size", [149, 2001, "x", None])
def test_chunk_size_refused(size):
    with pytest.raises(ValueError):
        chunking.validate_chunk_size(size)
