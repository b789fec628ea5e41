"""Removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash
among the runs of ``gram`` words in it, so equal windows have equal minimisers.
Consecutive windows with the same minimiser at the same place form a
super-k-mer, which travels as one packed string to the bucket of its minimiser;
sorting the windows of a bucket counts them exactly.

1. Super-k-mers are counted per minimiser. One whose minimiser occurs once holds
   no repeated window (two equal windows never share a super-k-mer) and stays.
2. The others are cut out of their documents, folded with equal ones of the same
   task and sent to their buckets. Equal strings count as one with a weight, so
   copies do not fill a bucket.
3. Minimisers with more than ``hot`` different super-k-mers (a line found in very
   many documents) would make large buckets: their windows are counted one by
   one, keyed by the 128-bit BLAKE2b of their words, which spreads them evenly.
4. Repeated windows return to the documents as ranges, joined by document.

Null and empty texts have no words. Texts shorter than a window stay as they
are. Repeated rows are documents of their own, so they remove each other's
windows; rows that have the same key and text get the same result. What a row
gathers does not grow with its repeats, and super-k-mers that recur within a
text (``x x x ...``) are one entry with the list of their places. An empty table
gives an empty one; columns other than key and text are not looked at, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage
from .rows import SLICE, WordHasher, _powers, bound_batches, mix

WINDOW = 35
GRAM = 5
# Different super-k-mers a bucket may hold per minimiser.
HOT = 10_000
_PLACE_BITS = 20
_SLICE_BYTES = 1 << 21
_CHUNK_ROWS = 20_000
_HELD_BYTES = 16 << 20
_BASES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_OCCURRENCE = "m bigint, f bigint, k1 bigint, k2 bigint, c int, starts array<int>"


class _Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int) -> None:
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.zeros(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self._up.size:
            size = 1 << max(16, n.bit_length())
            self._up, self._down = _powers(self._base, size), _powers(self._inverse, size)
        return self._up[:n], self._down[:n]


class RunHasher:
    """Numbers of runs of words from their words' numbers: a polynomial, by differences of prefix sums."""

    def __init__(self, base: int = _BASES[0]) -> None:
        self._powers = _Powers(base)

    def __call__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._powers(words.size + 1)
        sums = np.zeros(words.size + 1, np.uint64)
        np.cumsum(words * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[: out.size - size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: out.size - rest], out[rest:]) if rest else out


def joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array of bytes and where each begins."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(d) + 1 for d in data])
    return np.frombuffer(b"\n".join([*data, b""]), np.uint8), np.cumsum(sizes) - sizes


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of texts and, but for single long ones, of bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
    at = 0
    while at < batch.num_rows:
        ends = np.cumsum(sizes[at : at + SLICE])
        n = max(1, int(np.searchsorted(ends, _SLICE_BYTES, "right")))
        yield batch.slice(at, n)
        at += n


class SuperKmers:
    """The super-k-mers of a slice of texts."""

    def __init__(self, window: int, gram: int) -> None:
        self._window, self._gram = window, gram
        self._words, self._runs = WordHasher(), RunHasher()

    def __call__(self, texts: list):
        """``(text number, minimiser, run hash, first window, windows)``, one entry per super-k-mer."""
        window, gram = self._window, self._gram
        data, begins = joined(texts)
        starts, _, words = self._words(data)
        n = words.size - window + 1
        if n <= 0:
            return None
        owner = np.searchsorted(begins, starts, "right") - 1
        first = np.searchsorted(owner, np.arange(len(texts)))  # number of the first word of each text
        at = np.arange(words.size - gram + 1)
        grams = self._runs(words, at, at + gram)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        step = (1 << _PLACE_BITS) - window
        least = np.empty(n, np.uint64)
        for b in range(0, n, step):
            own = grams[b : min(b + step, n) + window - gram]
            # The place in the low bits makes the leftmost of equal grams the smallest.
            placed = own & ~low | np.arange(own.size, dtype=np.uint64)
            least[b : b + step] = sliding_min(placed, window - gram + 1)
        whole = owner[:n] == owner[window - 1 :]
        opens = np.ones(n, bool)
        opens[1:] = (least[1:] != least[:-1]) | (owner[1:n] != owner[: n - 1])
        opens &= whole
        # A super-k-mer ends where the next one opens or its text has no further window.
        heads = np.flatnonzero(opens)
        if not heads.size:
            return None
        last = np.searchsorted(owner, owner[heads], "right") - window  # last window of the text
        nexts = np.append(heads[1:], n)
        count = np.minimum(nexts, last + 1) - heads
        run = self._runs(words, heads, heads + count + window - 1)
        minimiser = (least[heads] >> np.uint64(_PLACE_BITS)).astype(np.int64)
        return owner[heads], minimiser, run.view(np.int64), heads - first[owner[heads]], count


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(k1, k2, id, text)``: the key and a 64-bit hash of the text tell rows of different texts apart.

    A key, or null, may be shared by any number of rows: among 10 million
    texts under one key two agree with a probability of about 3 in a million.
    """
    whole = isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    number = F.col(key).cast("bigint") if whole else F.xxhash64(key)
    return docs.select(
        F.coalesce(number, F.lit(-1)).alias("k1"), F.xxhash64(text).alias("k2"), F.col(key).alias("id"), F.col(text).alias("text")
    )


def occurrences(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = SuperKmers(window, gram)
        for batch in batches:
            for part in slices(batch, 2):
                found = cut(part.column(2).to_pylist())
                if found is None:
                    continue
                owner, m, f, s, c = found
                # Equal super-k-mers of a text are one entry with all their places.
                order = np.lexsort((s, c, f, m, owner))
                owner, m, f, s, c = (x[order] for x in found)
                new = np.ones(s.size, bool)
                new[1:] = (owner[1:] != owner[:-1]) | (m[1:] != m[:-1]) | (f[1:] != f[:-1]) | (c[1:] != c[:-1])
                heads = np.flatnonzero(new)
                bounds = pa.array(np.append(heads, s.size).astype(np.int32))
                starts = pa.ListArray.from_arrays(bounds, pa.array(s.astype(np.int32)))
                rows = part.select([0, 1]).take(pa.array(owner[heads]))
                columns = [pa.array(m[heads]), pa.array(f[heads]), *rows.columns, pa.array(c[heads].astype(np.int32)), starts]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "f", "k1", "k2", "c", "starts"])

    return keyed.select("k1", "k2", "text").mapInArrow(work, _OCCURRENCE)


def _packed(cut_out: DataFrame, window: int) -> DataFrame:
    """``(m, f, packed, n)``: the strings of the listed super-k-mers, equal ones of a task folded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        size = 0

        def flush():
            m, f, packed = zip(*held)
            arrays = [pa.array(m, pa.int64()), pa.array(f, pa.int64()), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(held.values(), pa.int64())], names=["m", "f", "packed", "n"])

        for batch in batches:
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                for one in wanted.as_py():
                    s = one["starts"][0]
                    packed = b" ".join(words[s : s + one["c"] + window - 1])
                    entry = (one["m"], one["f"], packed)
                    size += 0 if entry in held else len(packed)
                    held[entry] = held.get(entry, 0) + len(one["starts"])
                if size > _HELD_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    # With the same columns as the last join, both read one exchange of the texts.
    return cut_out.select("id", "text", "wanted").mapInArrow(work, "m bigint, f bigint, packed binary, n bigint")


class _Bucket:
    """Exact counts of the windows of packed super-k-mers."""

    def __init__(self, window: int) -> None:
        self._window = window
        self._words, self._runs = WordHasher(), RunHasher(_BASES[1])

    def __call__(self, packed: list[bytes], weights: list[int]) -> list[list[int]]:
        """For each string, the ranges of its windows that occur more than once, as ``[start, end, start, end, ...]``."""
        window = self._window
        text = b" ".join(packed)
        starts, ends, words = self._words(np.frombuffer(text, np.uint8))
        sizes = np.cumsum([len(p) + 1 for p in packed])
        owner = np.searchsorted(sizes, starts, "right")
        n = words.size - window + 1
        at = np.flatnonzero(owner[:n] == owner[window - 1 :])
        number = self._runs(words, at, at + window)
        order = np.argsort(number, kind="stable")
        at, number = at[order], number[order]
        weight = np.array(weights)[owner[at]]
        heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        repeated = np.repeat(np.add.reduceat(weight, heads) > 1, np.diff(np.append(heads, at.size)))
        # Equal numbers are compared word by word before they count as equal windows.
        lengths = np.diff(np.append(heads, at.size))
        a, b = starts[at].tolist(), ends[at + window - 1].tolist()
        for head, length in zip(heads[lengths > 1].tolist(), lengths[lengths > 1].tolist()):
            same = text[a[head] : b[head]]
            if any(text[a[i] : b[i]] != same for i in range(head + 1, head + length)):
                counts: dict[bytes, int] = {}
                for i in range(head, head + length):
                    own = text[a[i] : b[i]]
                    counts[own] = counts.get(own, 0) + int(weight[i])
                for i in range(head, head + length):
                    repeated[i] = counts[text[a[i] : b[i]]] > 1
        places = np.sort(at[repeated])
        out: list[list[int]] = [[] for _ in packed]
        if places.size:
            first = np.searchsorted(owner, np.arange(len(packed)))
            new = np.flatnonzero(np.concatenate([[True], (np.diff(places) > 1) | (np.diff(owner[places]) > 0)]))
            stop = np.append(new[1:], places.size) - 1
            for o, lo, hi in zip(owner[places[new]].tolist(), places[new].tolist(), places[stop].tolist()):
                out[o] += [lo - int(first[o]), hi + 1 - int(first[o])]
        return out


def _counted(packed: DataFrame, window: int) -> DataFrame:
    """``(m, f, ranges)`` of the super-k-mers that hold repeated windows."""
    dealt = packed.repartition("m").sortWithinPartitions("m", "f", "packed")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _Bucket(window)
        held: list[list] = []  # [m, f, packed, n], sorted; equal ones folded

        def done(rows: list[list]):
            ranges = count([r[2] for r in rows], [r[3] for r in rows])
            hit = [i for i, own in enumerate(ranges) if own]
            if hit:
                columns = [
                    pa.array([rows[i][0] for i in hit], pa.int64()),
                    pa.array([rows[i][1] for i in hit], pa.int64()),
                    pa.array([ranges[i] for i in hit], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "f", "ranges"])

        for batch in batches:
            for m, f, own, n in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][0] == m and held[-1][2] == own:
                    held[-1][3] += n
                    continue
                if len(held) >= _CHUNK_ROWS and held[-1][0] != m:
                    yield from done(held)
                    held = []
                held.append([m, f, own, n])
        if held:
            yield from done(held)

    return dealt.mapInArrow(work, "m bigint, f bigint, ranges array<int>")


def _single_windows(cut_out: DataFrame, window: int) -> DataFrame:
    """``(k1, k2, w, h1, h2)``: every window of the listed super-k-mers with the 128-bit hash of its words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, k1, k2, text, wanted in zip(*batch.columns):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                spaced = b" ".join(words)
                sizes = np.array([len(w) for w in words])
                ends = np.cumsum(sizes + 1) - 1
                at = np.concatenate([np.arange(s, s + x["c"]) for x in wanted.as_py() for s in x["starts"]])
                bounds = zip((ends - sizes)[at].tolist(), ends[at + window - 1].tolist())
                hashes = b"".join(blake2b(spaced[a:b], digest_size=16).digest() for a, b in bounds)
                h1, h2 = np.frombuffer(hashes, "<i8").reshape(-1, 2).T.copy()
                ids = [pa.array([k.as_py()] * at.size, k.type) for k in (k1, k2)]
                arrays = [*ids, pa.array(at.astype(np.int32)), pa.array(h1), pa.array(h2)]
                yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "w", "h1", "h2"])

    columns = cut_out.select("id", "k1", "k2", "text", "wanted")
    return columns.mapInArrow(work, "k1 bigint, k2 bigint, w int, h1 bigint, h2 bigint")


def repeated_ranges(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(k1, k2, ranges)``: per document the ranges of windows that start more than once anywhere."""
    found = occurrences(keyed, window, gram)
    kinds = found.groupBy("m", "f").agg(F.sum(F.size("starts")).alias("n"))
    shared = kinds.groupBy("m").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).where("n > 1")
    shared = stage(shared.select("m", (F.col("kinds") > hot).alias("hot")), "minimisers")
    kept = stage(found.join(shared, "m"), "super-k-mers")

    def cut_out(rows: DataFrame) -> DataFrame:
        # At most a document's own super-k-mers are gathered in its row.
        wanted = rows.groupBy("k1", "k2").agg(F.collect_set(F.struct("m", "f", "c", "starts")).alias("wanted"))
        return keyed.join(wanted, ["k1", "k2"])

    even = kept.where("NOT hot").drop("hot")
    hits = _counted(_packed(cut_out(even), window), window)
    pairs = even.select("m", "f", "k1", "k2", "starts").join(hits, ["m", "f"])
    offset = F.flatten(F.transform("starts", lambda s: F.transform("ranges", lambda x: x + s)))
    ranges = pairs.select("k1", "k2", offset.alias("ranges"))
    if shared.where("hot").limit(1).count():
        # Not stored: in one plan with the joins above it reads the same exchange of the texts.
        single = _single_windows(cut_out(kept.where("hot")), window)
        more = single.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
        many = single.join(more, ["h1", "h2"]).select("k1", "k2", F.array("w", F.col("w") + 1).alias("ranges"))
        ranges = ranges.union(many)
    # As a set: repeated rows bring the same ranges, which are folded before they are shuffled.
    return ranges.groupBy("k1", "k2").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """``(key, n_words, n_removed, kept)`` per row; ``kept`` holds the words left, joined by one space."""
    bound_batches(docs.sparkSession)
    keyed = _keyed(docs, key, text)
    marked = keyed.join(repeated_ranges(keyed, window, gram, hot), ["k1", "k2"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                bounds = ranges.as_py()
                if bounds:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, bounds[::2], 1)
                    np.add.at(edges, np.array(bounds[1::2]) + window - 1, -1)
                    keep = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
                    words = [words[i] for i in keep]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            columns = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "n_removed", "kept"])

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    return marked.select(F.col("id").alias(key), "text", "ranges").mapInArrow(work, schema)
