"""Small tables and brute-force versions shared by the tests."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Nulls in every column, empty and blank texts, ties, repeated rows.
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
    (1, "another text under the same id", "en", None, None),
    (2, None, None, None, None),
    (None, "a text without an id", "en", "b", 20),
    (None, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n", "de", "a", 3),
    (5, "12345 !!! 67890", "fr", "a", 15),
    (6, "word " * 40_000, "en", "c", 200_000),
]


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
