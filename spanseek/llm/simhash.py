"""SimHash fingerprints and near-duplicates through an index of byte positions.

A fingerprint is eight bytes. Two that differ in at most two bits share at
least six of the eight bytes at their positions, so six is the minimum number
of matches. The inverted index holds a posting for every set of six positions
and the bytes there: fingerprints meet in a posting exactly if their tally of
shared positional bytes reaches the minimum. (Postings of single bytes would
hold 1/256 of all fingerprints each; six bytes keep them short.) Of the pairs
in a posting, those within the bit distance are kept. A posting holds distinct
fingerprints that differ in two bytes only, hence at most 65,536 of them, and
long ones are probed by flipping bits instead of by pairs, so no group of
copies or near-copies grows the work with its square.

Null texts and texts without words have fingerprint zero and are linked like
any other. Fewer words than a shingle: the whole sequence is the one shingle.
Repeated rows each get a row; a null ``doc_id`` is never a ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage
from . import rows
from .components import connected

SHINGLE = 3
DISTANCE = 2
SEED = 42
_BYTES = 8
_SHINGLES = 1 << 16  # hashed at a time
_PAIRWISE = 64  # postings up to this size are compared pair by pair


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    starts, ends = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SHINGLES):
        bounds = zip(starts[at : at + _SHINGLES], ends[at : at + _SHINGLES])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in bounds], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE, into: str = "fp"
) -> DataFrame:
    """Rows of ``docs`` with their fingerprint."""

    def factory():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return rows.append(docs, text, [T.StructField(into, T.LongType())], factory, keep)


def _least_shared(distance: int) -> int:
    if not 0 <= distance < _BYTES:
        raise ValueError("the distance must be from 0 to 7 bits")
    return _BYTES - distance


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(a, b)``: all pairs of distinct fingerprints ``fp`` of ``prints`` at most ``distance`` bits apart, once each."""
    shared = _least_shared(distance)
    sets = list(combinations(range(_BYTES), shared))
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    entries = [F.struct(F.lit(n).alias("positions"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for n, m in enumerate(signed)]
    postings = prints.select("fp").distinct().select("fp", F.inline(F.array(*entries)))
    dealt = postings.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes", "fp")

    # The set of positions at which a pair is reported, by which of its bytes differ.
    first = np.full(256, -1)
    for differ in range(256):
        own = [n for n, chosen in enumerate(sets) if not any(differ >> p & 1 for p in chosen)]
        first[differ] = own[0] if own else -1

    def checked(n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs reach the tally, lie within the distance and belong to this posting."""
        apart = a ^ b
        differs = (apart.view(np.uint8).reshape(-1, 8) != 0) @ (1 << np.arange(8))
        tally = _BYTES - np.bitwise_count(differs.astype(np.uint8))
        return (tally >= shared) & (np.bitwise_count(apart) <= distance) & (first[differs] == n)

    def probes(n: int) -> np.ndarray:
        free = [8 * p + i for p in range(_BYTES) if p not in sets[n] for i in range(8)]
        flips = [sum(1 << b for b in chosen) for size in range(1, distance + 1) for chosen in combinations(free, size)]
        return np.array(flips, np.uint64)

    def pairs(n: np.ndarray, key: np.ndarray, fp: np.ndarray):
        cut = np.flatnonzero((n[1:] != n[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate([[0], cut])
        sizes = np.diff(np.concatenate([starts, [n.size]]))
        short = np.repeat(np.where(sizes <= _PAIRWISE, starts, -1), sizes)
        for step in range(1, min(_PAIRWISE, int(sizes.max()))):
            at = np.flatnonzero((short[step:] == short[:-step]) & (short[step:] >= 0))
            if not at.size:
                break
            a, b = fp[at], fp[at + step]
            ok = checked(n[at], a, b)
            yield a[ok], b[ok]
        for start, size in zip(starts[sizes > _PAIRWISE].tolist(), sizes[sizes > _PAIRWISE].tolist()):
            own = np.sort(fp[start : start + size])
            for flip in probes(int(n[start])):
                other = own ^ flip
                at = np.minimum(np.searchsorted(own, other), size - 1)
                hit = (own[at] == other) & (own < other)
                a, b = own[hit], other[hit]
                ok = checked(n[start], a, b)
                yield a[ok], b[ok]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the rows of a posting that may go on in the next batch

        def found(columns):
            for a, b in pairs(*columns):
                if a.size:
                    yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            if not batch.num_rows:
                continue
            new = (
                batch.column("positions").to_numpy(),
                batch.column("bytes").to_numpy(),
                batch.column("fp").to_numpy().view(np.uint64),
            )
            held.append(new)
            if held[0][0][0] == new[0][-1] and held[0][1][0] == new[1][-1]:
                continue  # one posting so far, at most 65,536 rows
            n, key, fp = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((n != n[-1]) | (key != key[-1]))[-1] + 1
            yield from found((n[:last], key[:last], fp[:last]))
            held = [(n[last:], key[last:], fp[last:])]
        if held:
            yield from found(tuple(np.concatenate(x) for x in zip(*held)))

    return dealt.select("positions", "bytes", "fp").mapInArrow(work, "a bigint, b bigint")


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(fp, root)`` for all distinct fingerprints of ``prints``."""
    distinct = prints.select("fp").distinct()
    found = connected(links(prints, distance))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(key, fp, component_id)`` per row: the smallest key among all documents in reach through links."""
    prints = stage(fingerprints(docs, text, [key], shingle), "fingerprints")
    # Copies fold to one row per fingerprint before anything is joined.
    firsts = prints.groupBy("fp").agg(F.min(key).alias("first"))
    roots = stage(firsts.join(components(prints, distance), "fp"), "roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest key (null last), whole repeats folded to one."""
    prints = stage(fingerprints(docs, text, [key], shingle), "fingerprints")
    roots = components(prints, distance)
    place = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("id"), F.col("fp"))
    firsts = prints.groupBy("fp").agg(F.min(place).alias("place"))
    best = firsts.join(roots, "fp").groupBy("root").agg(F.min("place").alias("place"))
    best = best.select(F.col("place.id").alias("__id"), F.col("place.fp").alias("__best"))
    marked = fingerprints(docs, text, None, shingle, "__fp")
    kept = marked.join(best, (F.col(key).eqNullSafe(F.col("__id"))) & (F.col("__fp") == F.col("__best")), "left_semi")
    return kept.dropDuplicates([key, "__fp"]).select(*docs.columns)
