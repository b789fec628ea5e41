"""Row types shared by all operators.

Offsets are code points of newline-normalised text; spans are half-open.
``pos`` is the position of an item in its input and serves as row id: ids
given by users may repeat, positions do not.
"""

from __future__ import annotations

from pyspark.sql import types as T

SPAN_KEY = ["file_path", "first_character_index"]
SPAN = SPAN_KEY + ["last_character_index"]

span_type = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("first_character_index", T.IntegerType()),
        T.StructField("last_character_index", T.IntegerType()),
    ]
)

file_listing = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rel_path", T.StringType()),
        T.StructField("ext", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("mtime", T.DoubleType()),
    ]
)

chunk = T.StructType(span_type.fields + [T.StructField("content", T.StringType())])

question_item = T.StructType(
    [
        T.StructField("question_id", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("difficulty", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
    ]
)

truth_item = T.StructType(
    question_item.fields
    + [
        T.StructField("sources", T.ArrayType(span_type)),
        T.StructField("answer", T.StringType()),
    ]
)

result_item = T.StructType(
    [
        T.StructField("question_id", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("question_str", T.StringType()),
        T.StructField("retrieved_sources", T.ArrayType(span_type)),
    ]
)

ingest_state = T.StructType(
    [
        T.StructField("max_chunk_size", T.IntegerType()),
        T.StructField("extensions", T.ArrayType(T.StringType())),
        T.StructField("path", T.StringType()),
        T.StructField("last_modif", T.DoubleType()),
    ]
)
