"""Less work before a shuffle or a model: membership filters and equal texts folded."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

# Bits of a membership filter: so many per key, and at most.
_BITS_PER_KEY = 12
MAX_FILTER_BITS = 1 << 28
_HASHES = 4
_WORD = 64


def _positions(key: Column, bits: int) -> Column:
    """``_HASHES`` bit positions of a key, from two hashes of it."""
    first, second = F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(F.lit(1), key), F.lit(bits))
    return F.array(*[F.pmod(first + second * F.lit(i), F.lit(bits)) for i in range(_HASHES)])


def membership_filter(keys: DataFrame, column: str, max_bits: int = MAX_FILTER_BITS) -> Callable[[Column], Column]:
    """A Bloom filter of a column: a condition that holds for all its values and few others.

    The tasks make the bits; a word of 64 bits is a row, so at most
    ``max_bits / 64`` rows come to the driver and are broadcast, however many
    keys there are. More keys make the filter let more through, never less.
    """
    n = keys.count()
    bits = min(max_bits, max(1 << 10, 1 << (n * _BITS_PER_KEY).bit_length()))
    places = keys.select(F.explode(_positions(F.col(column), bits)).alias("at"))
    bit = F.expr(f"shiftleft(1L, cast(at % {_WORD} as int))")
    words = places.groupBy(F.expr(f"at div {_WORD}").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(bits // _WORD, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def held(positions: pa.Array) -> pa.Array:
        at = positions.flatten().to_numpy().reshape(len(positions), _HASHES)
        found = shared.value[at // _WORD] >> (at % _WORD).astype(np.uint64) & np.uint64(1)
        return pa.array(found.all(axis=1))

    # Only positions go to Python; other columns of the row stay where they are.
    return lambda key: held(_positions(key, bits))


def once_per_text(df: DataFrame, column: str, run: Callable[[DataFrame], DataFrame], made: str) -> DataFrame:
    """``df`` with the column ``made`` that ``run`` adds to a table of the distinct texts of ``column``.

    Texts are told apart by 128 bits of hash and length. Each distinct text is one row for ``run``;
    its result, stored once, comes back by a join on the hash, in which adaptive
    execution splits a text that very many rows share.
    """
    key = F.struct(F.xxhash64(column).alias("low"), F.xxhash64(F.lit(1), column).alias("high"), F.octet_length(column).alias("size"))
    # "key" is never null, so rows without a text meet their result too.
    rows = df.withColumn("__text", key)
    distinct = rows.groupBy("__text").agg(F.first(column).alias(column))
    results = stage(run(distinct).select("__text", made), "per-text")
    keep = [c for c in df.columns if c != made]
    return rows.select("__text", *keep).join(results, "__text").select(*keep, made)
