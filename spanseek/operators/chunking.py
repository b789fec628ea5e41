"""Decode files and cut texts into bounded spans.

Where the next window starts depends on where the last one ended, so a text
is walked in order; different texts are independent. The walk runs map-side on
Arrow batches: no shuffle, and output batches of bounded size however long a
text is. It emits the content with the spans because ``substring`` on a long
text would scan it from the start once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_CHUNK_SIZE,
    DEFAULT_EXTENSIONS,
    MAX_CHUNK_SIZE,
    MIN_CHUNK_SIZE,
    SEPARATORS,
    STRONG_CUT_SHARE,
    WEAK_CUT_SHARE,
)
from ..functions import is_blank, normalise_newlines, path_suffix
from ..schemas import chunk as chunk_schema

_BATCH_CHARS = 8 << 20
_ARROW_CHUNK = pa.schema(
    [
        ("file_path", pa.string()),
        ("first_character_index", pa.int32()),
        ("last_character_index", pa.int32()),
        ("content", pa.string()),
    ]
)


def validate_chunk_size(value) -> int:
    """The chunk size as an integer within its limits, else ``ValueError``."""
    try:
        size = int(value)
    except (TypeError, ValueError):
        raise ValueError("the chunk size must be an integer") from None
    if not MIN_CHUNK_SIZE <= size <= MAX_CHUNK_SIZE:
        raise ValueError(f"the chunk size must be {MIN_CHUNK_SIZE} to {MAX_CHUNK_SIZE}")
    return size


def decode_text(files: DataFrame) -> DataFrame:
    """``(path, content)`` to ``(file_path, ext, text)``.

    Content that is not UTF-8 and empty content give no row; newlines are
    normalised, so that offsets count every line break as one character.
    """
    text = normalise_newlines(F.try_validate_utf8(F.col("content").cast("string")))
    return files.select(
        F.col("path").alias("file_path"), path_suffix(F.col("path")).alias("ext"), text.alias("text")
    ).where(F.length("text") > 0)


def filter_extensions(docs: DataFrame, extensions: list[str] = DEFAULT_EXTENSIONS) -> DataFrame:
    """Keep documents whose suffix is listed; ``.PY`` is not ``.py``."""
    return docs.where(F.col("ext").isin(list(extensions)))


def _window_end(text: str, start: int, stop: int, levels) -> int:
    """End of the chunk whose window is ``text[start:stop]``.

    The first separator found decides: if its cut is too early the window is
    cut hard, weaker separators are not consulted.
    """
    for separators, share in levels:
        for separator in separators:
            at = text.rfind(separator, start, stop)
            if at >= 0:
                cut = at + len(separator)
                return cut if cut - start > share * (stop - start) else stop
    return stop


def _spans(text: str, ext: str, size: int) -> Iterator[tuple[int, int]]:
    strong, weak = SEPARATORS.get(ext, SEPARATORS[""])
    levels = ((strong, STRONG_CUT_SHARE), (weak, WEAK_CUT_SHARE))
    start, length = 0, len(text)
    while start < length:
        stop = start + size
        end = length if stop >= length else _window_end(text, start, stop, levels)
        yield start, end
        start = end


def _chunker(size: int, drop_blank: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, firsts, lasts, contents, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array(firsts, pa.int32()),
                    pa.array(lasts, pa.int32()),
                    pa.array(contents, pa.string()),
                ],
                schema=_ARROW_CHUNK,
            )

        for batch in batches:
            for path, ext, value in zip(*batch.columns):
                path, text = path.as_py(), value.as_py()
                for first, last in _spans(text, ext.as_py(), size):
                    content = text[first:last]
                    if drop_blank and content.isspace():
                        continue
                    paths.append(path)
                    firsts.append(first)
                    lasts.append(last)
                    contents.append(content)
                    held += last - first
                    if held >= _BATCH_CHARS:
                        yield flush()
                        paths, firsts, lasts, contents, held = [], [], [], [], 0
        if paths:
            yield flush()

    return cut


def chunk_documents(
    docs: DataFrame, max_chunk_size: int = DEFAULT_CHUNK_SIZE, drop_blank: bool = True
) -> DataFrame:
    """Cut ``(file_path, text)`` into ``(file_path, first…, last…, content)``.

    Spans tile the text; separators depend on the suffix of ``file_path`` in
    lower case. White-space-only chunks are dropped, the offsets still advance.
    """
    size = validate_chunk_size(max_chunk_size)
    rows = docs.where(F.length("text") > 0).select(
        "file_path", F.lower(path_suffix(F.col("file_path"))).alias("ext"), "text"
    )
    return rows.mapInArrow(_chunker(size, drop_blank), chunk_schema)


def blank_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks of white space only, from ``chunk_documents(..., drop_blank=False)``."""
    return chunks.where(is_blank(F.col("content")))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Chunks, characters covered and longest chunk per file."""
    length = F.col("last_character_index") - F.col("first_character_index")
    return chunks.groupBy("file_path").agg(
        F.count("*").alias("n_chunks"),
        F.sum(length).alias("n_chars"),
        F.max(length).alias("max_chars"),
        F.min("first_character_index").alias("first_char"),
        F.max("last_character_index").alias("last_char"),
    )
