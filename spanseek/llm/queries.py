"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import new_folder
from . import (
    byte_bpe,
    decontaminate,
    filter_audit,
    language,
    oracles,
    perplexity,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    token_alignment,
    toxicity,
    warc,
    weighted_sampling,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether a row's crc32(key as text) mod ``parts`` is ``part``; no for null keys."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))


def tokenizer() -> byte_bpe.Tokenizer:
    import public_tokenizers

    return byte_bpe.Tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = tokenizer()
    decoded = tokens.decode(tokens.encode(docs, keep=["doc_id"]))
    return decoded.select(
        "doc_id",
        (F.length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_out("doc_id", 4, 2)
    model = language.train(docs, F.col("doc_id").isNotNull() & ~held)
    found = language.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find(docs, keep=["doc_id"])
    kinds = [rule.kind for rule in secret_scan.BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(kind) for kind in kinds],
        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substring_dedup.remove_repeats(docs)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = new_folder(spark, "warc")
    warc.write(warc.share_payloads(pages, "page_id", "html", "url"), archive)
    records = warc.read(spark, archive).where(F.col("record_type").isin("response", "revisit"))
    stored = F.col("record_type") == "response"

    def page(column: str) -> Column:
        return F.regexp_extract(column, ":(-?[0-9]+)>$", 1).try_cast("bigint")

    return records.select(
        page("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )



@query
def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "item_id", *[F.col(c).cast("bigint").alias(c) for c in ("distance", "start", "end")])


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = held_out("doc_id", 5, 0)
    model = toxicity.train(docs, labels, F.col("doc_id").isNotNull() & ~held, held_out("doc_id", 5, 4))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return perplexity.classify(docs, table(spark, sf_dir, "labels").where("quality = 1"))


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = "byte_bpe_50k.json", "piece_bpe_32k.model"
    vocabularies = token_alignment.Tokenizers(*map(public_tokenizers.path, names))

    def digest(shown: Column) -> Column:
        return F.when(F.col("n_a") > 0, F.sha2(shown.cast("binary"), 256)).otherwise(F.lit(""))

    aligned = token_alignment.align(docs, vocabularies, keep=["doc_id"], groups=digest)
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return aligned.select("doc_id", *counts, F.col("groups").alias("groups_sha256"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository; it imports this module

    return corpus_pipeline.run(spark, sf_dir)
