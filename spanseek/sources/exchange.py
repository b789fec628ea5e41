"""JSON exchange files: questions, ground truth, search results, answers.

A single JSON document is cut into its items by many tasks (``documents``).
Other forms are a directory of lines, one item each (``read_question_lines``,
``read_ground_truth_lines``, ``read_result_lines``), and the directory that
``write_results`` makes of one object, whose parts hold an item per line. Schemas are given, never inferred.
Broken JSON and items without a required field fail the load. Character indexes
may be written as any integral number or numeral (``5``, ``5.0``, ``"5"``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import question_item, result_item, span_type, truth_item
from ..staging import new_folder
from .documents import Document, read_document

# Spans as they are read: indexes are texts until they are known to be integral.
_RAW_SPANS = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in span_type.fieldNames()]))


def _raw(item: T.StructType) -> T.StructType:
    spans = T.ArrayType(span_type)
    return T.StructType([T.StructField(f.name, _RAW_SPANS if f.dataType == spans else f.dataType) for f in item.fields])


_LINE = T.StructType([T.StructField("pos", T.LongType()), *_raw(result_item).fields, T.StructField("k", T.IntegerType())])
_COPY_BYTES = 1 << 20
_OBJECT_HEAD = '{"search_results": ['
_OBJECT_TAIL = r'^\], "k": (-?[0-9]+)\}$'


def _required(column: Column, name: str) -> Column:
    return F.when(column.isNull(), F.raise_error(F.lit(f"missing or bad field: {name}"))).otherwise(column)


def _integral(text: Column) -> Column:
    """An int from any way to write an integral number, else null."""
    number = F.trim(text).try_cast("double")
    return F.when((number == F.floor(number)) & (F.abs(number) < 2**31), number.cast("int"))


def _spans(raw: Column) -> Column:
    path, first, last = span_type.fieldNames()
    return F.transform(
        raw, lambda s: F.struct(s[path].alias(path), _integral(s[first]).alias(first), _integral(s[last]).alias(last))
    )


def _valid_spans(spans: Column) -> Column:
    fields = span_type.fieldNames()
    return spans.isNotNull() & F.forall(
        spans, lambda s: s[fields[0]].isNotNull() & s[fields[1]].isNotNull() & s[fields[2]].isNotNull()
    )


def _line_items(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per line that is not blank; ``pos`` is unique and grows within a file."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return _parsed(lines.select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("raw")), schema)


def _parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    item = F.from_json("raw", _raw(schema)).alias("item")
    return rows.select(F.col("pos").cast("long").alias("pos"), F.json_object_keys("raw").alias("given"), item).select(
        "pos", "given", "item.*"
    )


def _question_columns() -> list[Column]:
    question = _required(F.col("question"), "question")
    given = lambda name: F.coalesce(F.array_contains("given", name), F.lit(False))
    return [
        # A repeatable id in place of a random one; an id that is there must not be null.
        F.when(given("question_id"), _required(F.col("question_id"), "question_id"))
        .otherwise(F.sha2(question, 256))
        .alias("question_id"),
        question.alias("question"),
        F.col("difficulty"),
        F.when(given("is_valid"), F.col("is_valid")).otherwise(F.lit(True)).alias("is_valid"),
    ]


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, question_id, question, difficulty, is_valid)``.

    The file holds a list, or an object whose first value is the list; any
    other shape gives no rows.
    """
    document = read_document(spark, path)
    listed = document.items(next(iter(document.members), ""))
    if listed is None:
        listed = document.pieces.where("false").selectExpr("number AS pos", "text AS raw")
    return _parsed(listed, question_item).select("pos", *_question_columns())


def read_question_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from lines of one item each."""
    return _line_items(spark, path, question_item).select("pos", *_question_columns())


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, question_id, question, difficulty, is_valid, sources, answer)``.

    The file holds ``{"rag_questions": [...]}`` or a list. An item counts as
    answered only with valid sources and an answer; else it has no sources.
    """
    document = read_document(spark, path)
    return _truth_columns(_parsed(_list_of(document, "" if document.kind == "[" else "rag_questions"), truth_item))


def _list_of(document: Document, key: str) -> DataFrame:
    listed = document.items(key)
    if listed is None:
        raise ValueError(f"missing or bad field: {key}")
    return listed


def read_ground_truth_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from lines of one item each."""
    return _truth_columns(_line_items(spark, path, truth_item))


def _truth_columns(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("sources", _spans(F.col("sources")))
    answered = _valid_spans(F.col("sources")) & F.col("answer").isNotNull()
    none = F.array().cast(T.ArrayType(span_type))
    return rows.select(
        "pos",
        *_question_columns(),
        F.when(answered, F.col("sources")).otherwise(none).alias("sources"),
        F.when(answered, F.col("answer")).alias("answer"),
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, question_id, question_str, retrieved_sources, k)`` of one result object.

    ``question`` is accepted for ``question_str`` and goes first if both are
    there; further fields, such as answers, are ignored. A directory is taken
    for the parts of one object, as ``write_results`` writes them, and read in
    parallel: ``pos`` is then unique and grows within a part.
    """
    if _is_folder(spark, path):
        return _read_object_parts(spark, path)
    document = read_document(spark, path)
    k = (document.scalar("k") or "").strip()
    if not re.fullmatch("-?[0-9]+", k):
        raise ValueError("missing or bad field: k")
    item = F.from_json("raw", _raw(result_item)).alias("item")
    rows = _list_of(document, "search_results").select("pos", F.lit(int(k)).alias("k"), item)
    return _result_columns(rows.select("pos", "k", "item.*"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def _read_object_parts(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    value = F.col("value")
    depth = lines.where(value.rlike(_OBJECT_TAIL)).agg(F.max(F.regexp_extract(value, _OBJECT_TAIL, 1).cast("int")))
    items = lines.where((value != _OBJECT_HEAD) & ~value.rlike(_OBJECT_TAIL) & (F.trim(value) != ""))
    item = F.from_json(F.regexp_replace(value, "^,", ""), _raw(result_item))
    rows = items.select(F.monotonically_increasing_id().alias("pos"), item.alias("item"))
    return _result_columns(rows.select("pos", _required(depth.scalar(), "k").alias("k"), "item.*"))


def read_result_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from a directory written by ``write_results``."""
    return _result_columns(spark.read.schema(_LINE).option("mode", "FAILFAST").json(path))


def _result_columns(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("retrieved_sources", _spans(F.col("retrieved_sources")))
    spans = F.col("retrieved_sources")
    checked = F.when(_valid_spans(spans), spans)
    return rows.select(
        "pos",
        _required(F.col("question_id"), "question_id").alias("question_id"),
        F.coalesce("question", "question_str").alias("question_str"),
        _required(checked, "retrieved_sources").alias("retrieved_sources"),
        "k",
    )


def normalize_paths(results: DataFrame, prefix: str) -> DataFrame:
    """Put ``prefix`` before every file path that does not start with it."""

    def prefixed(span: Column) -> Column:
        path = span["file_path"]
        return span.withField(
            "file_path", F.when(path.startswith(prefix), path).otherwise(F.concat(F.lit(prefix), path))
        )

    return results.withColumn("retrieved_sources", F.transform("retrieved_sources", prefixed))


def write_results(
    results: DataFrame, directory: str, name: str, k: int, prefix: str | None = None, layout: str = "lines"
) -> str:
    """Write results or answers below ``directory`` under the input's ``name``.

    ``lines`` writes one JSON object per result, with ``k``. ``object`` writes
    text parts that, put together in name order, are the one object
    ``{"search_results": [...], "k": k}``; a small result is a single part.
    Neither passes the results through one task. ``file`` puts these parts into
    one file that any JSON reader takes: blocks of them are copied one after the
    other, and the file gets its name when it is complete.
    """
    rows = results if prefix is None else normalize_paths(results, prefix)
    fields = [c for c in ("question_id", "question_str", "retrieved_sources", "answer") if c in rows.columns]
    target = f"{directory.rstrip('/')}/{name}"
    if layout == "lines":
        rows.select("pos", *fields, F.lit(k).alias("k")).write.mode("overwrite").json(target)
        return target
    item = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    first = rows.agg(F.min("pos")).scalar()
    lines = rows.select(
        F.lit(1).alias("section"), "pos", F.concat(F.when(F.col("pos") > first, ",").otherwise(""), item).alias("value")
    )
    frame = rows.sparkSession.createDataFrame(
        [(0, 0, _OBJECT_HEAD), (2, 0, f'], "k": {int(k)}}}')], "section int, pos long, value string"
    )
    ordered = lines.unionByName(frame).orderBy("section", "pos")
    parts = target if layout == "object" else new_folder(rows.sparkSession, "parts")
    ordered.select("value").write.mode("overwrite").text(parts)
    if layout == "file":
        join_parts(rows.sparkSession, parts, target)
    return target


def join_parts(spark: SparkSession, parts: str, target: str) -> None:
    """Copy the files of ``parts`` in order of their names into the one file ``target``, replacing it."""
    hadoop = spark._jvm.org.apache.hadoop
    settings = spark._jsc.hadoopConfiguration()
    folder, place, made = (hadoop.fs.Path(p) for p in (parts, target, f"{target}._joining"))
    source, system = folder.getFileSystem(settings), place.getFileSystem(settings)
    names = sorted(s.getPath().getName() for s in source.listStatus(folder) if s.getPath().getName().startswith("part-"))
    out = system.create(made, True)
    try:
        for name in names:
            part = source.open(hadoop.fs.Path(folder, name))
            try:
                hadoop.io.IOUtils.copyBytes(part, out, _COPY_BYTES, False)
            finally:
                part.close()
    finally:
        out.close()
    system.delete(place, True)
    if not system.rename(made, place):
        raise OSError(f"cannot write {target}")
    source.delete(folder, True)
