"""How the given tables become files, documents, questions and truth.

The expressions are the same in Spark and in the comparison SQL. Every table
is used whole: ``doc_id % 3`` and ``% 7`` give each document a kind of name,
they leave none out.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import path_suffix
from ..operators.evaluation import Truth, count_copies
from ..schemas import SPAN
from ..staging import spread_if_narrow, stage

# Items without an inner word are looked for in blocks of so many.
_SHORT_BLOCK = 500
_WORDS = r"[\s]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def structured(text: str, ext: str) -> str:
    """SQL: give raw text the marks of a kind of file, so all separators occur."""
    return {
        ".py": f"replace(replace({text}, chr(10) || 'A', chr(10) || 'def A'), chr(10) || 'E', chr(10) || 'class E')",
        ".md": f"replace({text}, chr(10) || 'A', chr(10) || '# A')",
        "": f"replace({text}, chr(10) || 'A', chr(10) || chr(10) || 'A')",
    }[ext]


EXT_OF_DOC = "CASE doc_id % 3 WHEN 0 THEN '.py' WHEN 1 THEN '.md' ELSE '' END"
MIXED_TEXT = (
    f"CASE doc_id % 3 WHEN 0 THEN {structured('text', '.py')} "
    f"WHEN 1 THEN {structured('text', '.md')} ELSE {structured('text', '')} END"
)
CATALOGUE_PATH = (
    "CASE doc_id % 7 WHEN 0 THEN 'src/a' || doc_id || '.py' WHEN 1 THEN 'docs/R' || doc_id || '.MD' "
    "WHEN 2 THEN 's' || doc_id || '/Dockerfile' WHEN 3 THEN '.github/w' || doc_id || '.yaml' "
    "WHEN 4 THEN 'pkg' || doc_id || '/__init__.py' WHEN 5 THEN 'dist/x' || doc_id || '.tar.gz' "
    "ELSE 'c' || doc_id || '/.gitignore' END"
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return spread_if_narrow(rows, "doc_id")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, file_path, ext, text)``: all documents, as three kinds of files."""
    path = f"source || '/d' || doc_id || {EXT_OF_DOC}"
    return _documents(spark, sf_dir).selectExpr(
        "doc_id", f"{path} AS file_path", f"{EXT_OF_DOC} AS ext", f"{MIXED_TEXT} AS text"
    )


def docs_of_kind(spark: SparkSession, sf_dir: str, ext: str) -> DataFrame:
    """All documents as files of one kind."""
    return _documents(spark, sf_dir).selectExpr(
        f"source || '/d' || doc_id || '{ext}' AS file_path", f"{structured('text', ext)} AS text"
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``docs`` as undecoded files with Windows line ends: ``(path, mtime, content)``."""
    content = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")).cast("binary")
    return docs(spark, sf_dir).select(
        F.col("file_path").alias("path"), F.col("doc_id").cast("double").alias("mtime"), content.alias("content")
    )


def write_files(named: DataFrame, root: str) -> None:
    """Write ``(path, content)`` as files below ``root``, a place all executors share, from the tasks."""

    def work(batches):
        for batch in batches:
            system, base = pafs.FileSystem.from_uri(root)
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(content)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    named.select("path", "content").mapInArrow(work, "n bigint").agg(F.sum("n")).collect()


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, rel_path, mtime)``: one file name per document, of seven shapes."""
    rows = table(spark, sf_dir, "documents")
    return rows.selectExpr(
        f"{CATALOGUE_PATH} AS path", f"{CATALOGUE_PATH} AS rel_path", "cast(n_chars AS double) AS mtime"
    )


def catalogue_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = catalogue(spark, sf_dir)
    return named.select(F.col("path").alias("file_path"), path_suffix(F.col("path")).alias("ext"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benchmark items as questions."""
    rows = table(spark, sf_dir, "benchmark")
    return rows.selectExpr("item_id AS pos", "cast(item_id AS string) AS question_id", "text AS question")


def passages(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """Documents that quote a question word for word: ``(question_id, span)``.

    A quoted passage brings its inner words along whole, so its longest inner
    word is an anchor that must occur in the document. Anchors meet the
    distinct words of documents in an equality join, and only those pairs are
    verified character by character. The few items of one or two words have no
    inner word; they are looked for in every text, a block of items at a time.
    """
    words = F.split(F.trim("question"), _WORDS)
    split = asked.select("question_id", "question", words.alias("words"))
    inner = split.where(F.size("words") > 2).select("question_id", F.slice("words", 2, F.size("words") - 2).alias("inner"))
    longest = F.array_max(F.transform("inner", lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))
    anchors = inner.select("question_id", longest["word"].alias("word"))

    found_words = F.explode(F.array_distinct(F.split("text", _WORDS))).alias("word")
    # Texts stay out of the anchor join and come back for the few pairs it finds.
    pairs = documents.select("file_path", found_words).join(anchors, "word").select("file_path", "question_id")
    checked = documents.select("file_path", "text").join(pairs, "file_path").join(asked, "question_id")
    at = F.position(F.col("question"), F.col("text"))
    found = checked.select("question_id", "file_path", at.alias("at"), F.length("question").alias("n"))
    return found.unionByName(_short_passages(documents, split)).where("at > 0").selectExpr(
        "question_id", "file_path", f"at - 1 AS {SPAN[1]}", f"at - 1 + n AS {SPAN[2]}"
    )


def _short_passages(documents: DataFrame, split: DataFrame) -> DataFrame:
    """``(question_id, file_path, at, n)`` for items of at most two words, map-side."""
    short = split.where(F.size("words") <= 2)
    blocks = -(-short.count() // _SHORT_BLOCK)
    out = documents.select(F.lit("").alias("question_id"), "file_path", F.lit(0).alias("at"), F.lit(0).alias("n")).where("false")
    for block in range(blocks):
        own = short.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == block).select("question_id", "question").collect()
        items = [F.struct(F.lit(r[0]).alias("question_id"), F.lit(r[1]).alias("question")) for r in own]
        if items:
            each = documents.select("file_path", "text", F.explode(F.array(*items)).alias("item"))
            at = F.position(F.col("item.question"), F.col("text"))
            out = out.unionByName(each.select("item.question_id", "file_path", at.alias("at"), F.length("item.question").alias("n")))
    return out


def truth(spark: SparkSession, sf_dir: str) -> Truth:
    """Truth of all benchmark items; items quoted nowhere have no spans.

    Built in long form: an item quoted by very many documents stays many rows.
    Staged, because an evaluation reads it more than once.
    """
    asked = questions(spark, sf_dir)
    spans = stage(passages(docs(spark, sf_dir), asked), "truth")
    counted = spans.groupBy("question_id").agg(F.count("*").alias("n"))
    items = asked.join(counted, "question_id", "left").select(
        "question_id", F.coalesce("n", F.lit(0)).alias("n_truth")
    )
    return Truth(items, count_copies(spans))


def source_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth items with repeated ids: one per labelled document, named by its source."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    named = docs(spark, sf_dir).join(labelled, "doc_id").join(
        table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id"
    )
    span = F.struct(
        "file_path",
        F.lit(0).alias("first_character_index"),
        F.length("text").alias("last_character_index"),
    )
    return named.select(F.col("doc_id").alias("pos"), F.col("source").alias("question_id"), F.array(span).alias("sources"))


def source_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with repeated and unknown ids: one per document, named by its source."""
    rows = table(spark, sf_dir, "documents")
    return rows.selectExpr("doc_id AS pos", "source AS question_id")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector as a query, ``(query_id, embedding)``."""
    rows = table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0")
    return rows.select(F.col("vec_id").alias("query_id"), "embedding")
