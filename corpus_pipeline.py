"""From raw documents to token ids in five stages over the operators of ``spanseek.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with the columns of ``docs``; the last one returns the tokenised documents.
``run`` writes every stage's rows as Parquet and gives them to the next, so a
lost executor repeats tasks of one stage only. Rows with nulls, empty texts and
repeated rows pass through as each stage says; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanseek.llm import decontaminate, language, secret_scan, simhash
from spanseek.llm.queries import held_out, table, tokenizer
from spanseek.staging import stage

# Less certain predictions are rejected.
LEAST_CERTAIN = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is unknown (null text, no letter) or uncertain."""
    model = language.train(docs, F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))
    found = language.predict(docs, model, into=("__lang", "__score"))
    sure = (F.col("__lang") != language.UNKNOWN) & (F.col("__score") >= LEAST_CERTAIN)
    return found.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest ``doc_id`` of each group of near duplicates."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    found = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), "__hits")
    return found.where("__hits = 0").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the text; ``n_chars`` follows the text where it was masked."""
    masked = secret_scan.redact(docs.withColumn("__before", F.length("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        grown = (F.length("text") - F.col("__before")).cast(kind)
        masked = masked.withColumn("n_chars", (F.col("n_chars") + F.coalesce(grown, F.lit(0).cast(kind))).cast(kind))
    return masked.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (packed), their number, and whether decoding gives the text back."""
    coder = tokenizer()
    encoded = coder.encode(docs.select("doc_id", "lang", "source", "text"))
    decoded = coder.decode(encoded)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        (F.length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("byte_bpe", tokens),
]

# Learnt models, graph search and tokenising have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
