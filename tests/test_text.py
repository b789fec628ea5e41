import pytest
from pyspark.sql import functions as F

from spanseek.functions import (
    after_last,
    clean_answer,
    clean_query,
    corpus_tokens,
    is_blank,
    path_suffix,
    query_terms,
    strip,
    two_decimals,
    url_suffix,
)


@pytest.fixture
def apply(spark):
    def run(expression, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]

    return run


def test_path_suffix(apply):
    names = ["a.py", ".gitignore", "a.tar.gz", "Dockerfile", "file.", "..x", ".a.b", "d.d/name", "d/x.MD", "a.p\ny"]
    assert apply(path_suffix, names) == [".py", "", ".gz", "", "", ".x", ".b", "", ".MD", ".p\ny"]


def test_url_suffix(apply):
    urls = ["http://a.example.com/x/1.html?v=2.zip", "https://a.example.com/x#b.c", "http://a.example.com", "https://h/p.tar.gz"]
    assert apply(url_suffix, urls) == [".html", "", "", ".gz"]


def test_after_last(apply):
    values = ["a\n\n\nb", "none", "x\n\ny\n\nz", "\n\n"]
    assert apply(lambda c: after_last(c, "\n\n"), values) == [4, 0, 6, 2]


def test_strip_knows_all_white_space(apply):
    values = [" \t\n a b   ", "\x1c\x85x\x1f", "", " "]
    assert apply(strip, values) == [v.strip() for v in values]


def test_blank(apply):
    values = ["", " \n", "  ", "\x1c", " a ", "​"]
    assert apply(is_blank, values) == [v.strip() == "" for v in values]


def test_corpus_tokens(apply):
    assert apply(corpus_tokens, ["The x_1 and é2 a", "Straße ÉTÉ été b-2 I9", "不 不不 कि"]) == [
        ["x_1", "é2"],
        ["straße", "été", "été", "i9"],
        ["不不"],
    ]


def test_query_terms(apply):
    assert apply(query_terms, ["What's config.json?", "  A  a_b c\t.", "", "??"]) == [
        ["what", "s", "config.json"],
        ["a", "a_b", "c", "."],
        [],
        [],
    ]


def test_clean_query_matches_python(apply):
    values = ["Ça-va? (oui) x_y.z !", "½ ² Ⅷ ́e", "a\x1cb\x85c"]
    expected = [
        "".join(c if c.isalnum() or c.isspace() or c in "_." else " " for c in v.lower()) for v in values
    ]
    assert apply(clean_query, values) == expected


def test_clean_answer(apply):
    raw = ["Answer: yes\nmore", "ok", "???", "  Answer:  two Answer: words \n", "\n\n a line\nb", "Answer:", ""]
    refusal = "I don't know"
    assert apply(clean_answer, raw) == ["yes", refusal, refusal, "two  words", "a line", refusal, refusal]


def test_two_decimals_are_rounded_as_printed(spark):
    values = [0.125, 3.125, 0.375, 2.675, 14.3, 100.0, 0.0, 0.005, 0.015, 66.66666666666667, 1 / 3]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(two_decimals(frame.v)).collect()] == [float(f"{v:.2f}") for v in values]
