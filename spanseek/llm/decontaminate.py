"""Benchmark items in documents, found by CGK embedding, bit sampling and exact edit distance.

The CGK random walk turns edit distance into Hamming distance: at step ``j`` it
emits the byte it stands on and moves on if a random bit of (``j``, byte) says
so, so that two texts fall back into step after an edit. Items and documents
are walked with the same bits, both from every word. A repetition draws a walk
of its own and samples steps of it; a window whose sampled bytes equal those of
an item is a candidate. Walks are short, so that some window of an item lies
between the edits even if a fifth of its characters are edited; items of
different length use walks of different length (``CLASSES``), whose numbers of
repetitions come from measured recall at the edit limit. A window is walked on
only while some window of an item begins with the bytes sampled so far.

The text around a candidate is verified by exact edit distance. Candidates are
first given the sum of the distances of the item's parts of 64 characters, a
lower bound of the distance, so that no item within the limit is given up.
Items are taken in blocks of bounded size; each block is one pass over the
documents, which are not shuffled.

Texts are compared in lower case with white space collapsed. An item is found
if at most ``share`` of its characters are edited. Null, empty and blank texts
and items are never found; repeated rows are each reported.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import append, bound_batches, ship

SHARE = 0.2
# Least bytes of an item, steps of its walks, steps sampled, repetitions (independent walks).
CLASSES = ((160, 32, 24, 4), (80, 20, 16, 4), (48, 16, 14, 5), (24, 12, 9, 6), (8, 6, 4, 5), (4, 4, 3, 2), (1, 1, 1, 1))
BLOCK_ITEMS = 10_000
# Characters of an item compared at a time for the lower bound.
_PART = 64
_SEED = 2
# Least bits of a place in a table of hints; there are four places a key or more.
_HINT_BITS = 18
_SLICE_BYTES = 1 << 20
# Windows walked and candidates bounded at a time; their numbers fit the processor's caches.
_WINDOWS = 1 << 15
_BOUND_ROWS = 1 << 12
# Shares of a walk after which windows that no item begins like are left out.
_STAGES = (0.32, 0.44, 0.63, 1.0)


def normalise(text: str | None) -> list[str]:
    """The words that are compared."""
    return (text or "").replace("\0", " ").lower().split()


def repetitions(recall: float, agreement: float, samples: int) -> int:
    """How often to sample so that a window with this agreement is found with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**samples))


class Walk:
    """A random walk with the steps it samples.

    Two steps are taken at a time: a table tells for every two bytes from a
    place on how far both steps go and which bytes they sample.
    """

    def __init__(self, steps: int, samples: int, number: int) -> None:
        draw = random.Random(f"{_SEED}:{steps}:{number}")
        # Bit j of a byte's number says whether step j moves on; zeros end texts and hold the walk.
        self.moves = np.array([0, *(draw.getrandbits(steps) for _ in range(255))], np.uint32)
        self.samples = sorted(draw.sample(range(steps), samples))
        self._tables: list[np.ndarray] = []

    def __getstate__(self) -> dict:
        # Tables are made where they are used.
        return self.__dict__ | {"_tables": []}

    def __len__(self) -> int:
        """The number of double steps."""
        return self.samples[-1] // 2 + 1

    def _step(self, j: int) -> np.ndarray:
        """For the bytes ``a``, ``b`` at ``a + 256 * b``: the way of steps ``j`` and ``j + 1`` in the two lowest bits, then what they sample."""
        # The walk stands still after its last sample.
        first, second = (self.moves >> np.uint32(i) & np.uint32(i < self.samples[-1]) for i in (j, j + 1))
        here = np.arange(256, dtype=np.uint32)[None, :]
        there = np.where(first[None, :] > 0, np.arange(256, dtype=np.uint32)[:, None], here)
        seen = here * np.uint32(j in self.samples) << np.uint32(8) | there * np.uint32(j + 1 in self.samples)
        return (seen << np.uint32(2) | first[None, :] + second[there]).ravel()

    def walk(self, pairs: np.ndarray, at: np.ndarray, stages: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(n, own, keys, at)`` after each double step ``n`` of ``stages``: window numbers, their sampled bytes as one number, places.

        The places are those read last if ``n`` is the last double step. Windows
        whose key has no place in the stage's table are not walked on. The
        arrays are changed by the next step.
        """
        if not self._tables:
            self._tables = [self._step(2 * n) for n in range(len(self))]
        own = np.arange(at.size)
        at = at.astype(np.int64)
        out = np.zeros(at.size, np.uint64)
        for n, table in enumerate(self._tables):
            seen = table.take(pairs.take(at))
            at += seen & np.uint32(3)
            seen >>= np.uint32(2)
            out *= np.uint64(0x100000001B3)
            out ^= seen
            if n in stages:
                hint = stages[n]
                near = np.flatnonzero(hint.take(_place(out, hint.size)))
                own, at, out = own.take(near), at.take(near), out.take(near)
                yield n, own, out, at


def _pairs(data: np.ndarray) -> np.ndarray:
    """Every byte with the next one."""
    out = data.astype(np.uint16)
    out[:-1] |= out[1:] << np.uint16(8)
    return out


def _place(keys: np.ndarray, places: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - places.bit_length())).view(np.int64)


def _hint(keys: np.ndarray) -> np.ndarray:
    """Whether some key has a place: no for nearly all others."""
    out = np.zeros(1 << max(_HINT_BITS, (4 * keys.size).bit_length()), bool)
    out[_place(keys, out.size)] = True
    return out


def _folded(text: str) -> np.ndarray:
    """Code points by their low byte: equal ones stay equal, so no distance grows."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint8)


class Index:
    """Sampled bytes of the windows of a block of items."""

    def __init__(self, items: list[tuple], share: float) -> None:
        self.items = [(key, " ".join(words)) for key, words in items]
        self.limits = np.array([int(share * len(text)) for _, text in self.items], np.int64)
        self.sizes = np.array([len(text) for _, text in self.items], np.int64)
        self.folded = np.concatenate([np.zeros(0, np.uint8), *(_folded(text) for _, text in self.items)])
        self.folded_at = np.cumsum(self.sizes) - self.sizes
        texts = [text.encode("utf-8", "surrogatepass") for _, text in self.items]
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        pairs = _pairs(np.frombuffer(b"\0".join([*texts, b""]), np.uint8))
        windows: dict[tuple, list] = {}
        for n, (_, words) in enumerate(items):
            kind = next(c for c in CLASSES if len(texts[n]) >= c[0])
            at = place = 0
            for word in words:
                windows.setdefault(kind, []).append((n, at, int(begin[n]) + place))
                at += len(word) + 1
                place += len(word.encode("utf-8", "surrogatepass")) + 1
        self.tables = []
        for (_, steps, samples, repeats), anchors in windows.items():
            owner, offset, place = (np.array(x, np.int64) for x in zip(*anchors))
            for number in range(repeats):
                walk = Walk(steps, samples, number)
                # Hints that leave nothing out.
                stages = {max(0, round(len(walk) * share) - 1): np.ones(1, bool) for share in _STAGES}
                walked = [(n, keys.copy(), last) for n, _, keys, last in walk.walk(pairs, place, stages)]
                _, keys, last = walked[-1]
                # A walk that leaves its item says nothing about documents.
                inside = np.flatnonzero(last < begin[owner + 1] - 1)
                hints = {n: _hint(np.unique(begun[inside])) for n, begun, _ in walked}
                order = inside[np.argsort(keys[inside], kind="stable")]
                self.tables.append((walk, hints, keys[order], owner[order], offset[order]))


def candidates(index: Index, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(window numbers, item numbers, offsets)``: windows whose samples equal those of an item."""
    pairs = _pairs(data)
    for walk, hints, keys, owner, offset in index.tables:
        left = []
        for some in range(0, starts.size, _WINDOWS):
            *_, (_, near, own, _) = walk.walk(pairs, starts[some : some + _WINDOWS], hints)
            left.append((near + some, own))
        near, own = (np.concatenate(x) for x in zip(*left))
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        counts = high - low
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        hit = np.repeat(low, counts) + within
        yield np.repeat(near, counts), owner[hit], offset[hit]


def _part_distances(index: Index, item: np.ndarray, begin: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least edit distance of an item's part from ``begin`` on to a part of ``text[first:last]`` (bit-parallel, many at once).

    The longest places come first. Up to 15 characters after ``last`` are read
    too, which can only make a distance smaller.
    """
    one = np.uint64(1)
    kinds, which = np.unique(item * (int(index.sizes.max()) + 1) + begin, return_inverse=True)
    kind, start = np.divmod(kinds, int(index.sizes.max()) + 1)
    size = np.minimum(index.sizes[kind] - start, _PART)
    # A part takes the highest bits; the bits below it match every character and change nothing.
    below = np.uint64(_PART) - size.astype(np.uint64)
    filled = np.where(size < _PART, (one << below % np.uint64(_PART)) - one, np.uint64(0))
    masks = np.repeat(filled, 256)
    for i in range(int(size.max())):
        has = np.flatnonzero(size > i)
        masks[has * 256 + index.folded[index.folded_at[kind[has]] + start[has] + i]] |= one << (below[has] + np.uint64(i))
    row = which * 256
    plus, minus = ~filled[which], np.zeros(item.size, np.uint64)
    score = size[which]
    best = score.copy()
    at = first.copy()
    cell = np.empty(item.size, np.int64)
    diagonal, up, down = (np.empty(item.size, np.uint64) for _ in range(3))
    whole = (row, plus, minus, score, best, at, cell, diagonal, up, down)
    steps = last - first
    for step in range(int(steps.max(initial=0))):
        if step % 16 == 0:
            going = int(np.count_nonzero(steps > step))
            row, plus, minus, score, least, at, cell, diagonal, up, down = (x[:going] for x in whole)
        np.add(row, text.take(at, mode="clip"), out=cell)
        at += 1
        eq = masks.take(cell)
        np.bitwise_and(eq, plus, out=diagonal)
        diagonal += plus
        diagonal ^= plus
        diagonal |= eq
        diagonal |= minus
        np.bitwise_or(diagonal, plus, out=up)
        np.invert(up, out=up)
        up |= minus
        np.bitwise_and(plus, diagonal, out=down)
        # As signed numbers, those with the highest bit become -1, others 0.
        np.right_shift(up.view(np.int64), 63, out=cell)
        score -= cell
        np.right_shift(down.view(np.int64), 63, out=cell)
        score += cell
        np.minimum(least, score, out=least)
        up <<= one
        down <<= one
        np.bitwise_or(diagonal, up, out=plus)
        np.invert(plus, out=plus)
        plus |= down
        np.bitwise_and(up, diagonal, out=minus)
    return best


def bounds(index: Index, item: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Whether the item may be within its limit in ``text[low:high]``, beginning at ``low`` up to ``low + slack``.

    The sum of the distances of the item's parts is a lower bound. The first two
    parts leave few candidates, whose other parts are compared together.
    """
    total = np.zeros(item.size, np.int64)
    most = -(-int(index.sizes[item].max(initial=0)) // _PART)
    for parts in ([0], [1], range(2, most)):
        alive = np.flatnonzero(total <= index.limits[item])
        own = np.repeat(alive, len(parts))
        begin = np.tile(np.array(parts, np.int64) * _PART, alive.size)
        inside = index.sizes[item[own]] > begin
        own, begin = own[inside], begin[inside]
        limit = index.limits[item[own]]
        # Where a part may lie, edits before it included.
        first = np.minimum(low[own] + np.maximum(begin - limit, 0), high[own])
        size = np.minimum(index.sizes[item[own]] - begin, _PART)
        last = np.minimum(low[own] + begin + size + slack[own] + limit, high[own])
        order = np.argsort(first - last, kind="stable")
        for some in range(0, order.size, _BOUND_ROWS):
            rows = order[some : some + _BOUND_ROWS]
            np.add.at(total, own[rows], _part_distances(index, item[own[rows]], begin[rows], text, first[rows], last[rows]))
    return total <= index.limits[item]


def edit_search(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a part of ``text`` and the first end of such a part (bit-parallel)."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    m = len(pattern)
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if score < best:
            best, end = score, i + 1
    return best, end


def verify(item: str, limit: int, text: str, at: int) -> tuple[int, int, int] | None:
    """``(distance, start, end)`` of the item near place ``at`` of ``text``, if within ``limit`` edits.

    Places up to half of ``limit`` after ``at`` need no look of their own.
    """
    low = max(0, at - limit - 2)
    window = text[low : at + len(item) + limit + limit // 2 + 2]
    distance, end = edit_search(item, window)
    if distance > limit or not end:
        return None
    _, size = edit_search(item[::-1], window[:end][::-1])
    return distance, low + end - size, low + end


def search_texts(index: Index, texts: list[list[str]]) -> list[tuple[int, int, int, int, int]]:
    """``(text number, item number, distance, start, end)`` in characters of the normalised texts."""
    strings = [" ".join(words) for words in texts]
    encoded = [s.encode("utf-8", "surrogatepass") for s in strings]
    data = np.frombuffer(b"\0".join([*encoded, b""]), np.uint8)
    gaps = (data == 0x20) | (data == 0)
    first = np.ones(data.size, bool)
    first[1:] = gaps[:-1]
    starts = np.flatnonzero(first & ~gaps)
    if not starts.size or not index.items:
        return []
    characters = starts - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), starts)
    ends = np.cumsum([len(s) + 1 for s in strings])
    begins = ends - [len(s) + 1 for s in strings]
    owners = np.searchsorted(ends, characters, "right")
    span = int(ends[-1]) + 1
    cells = []
    for window, item, offset in candidates(index, data, starts):
        # Places within half of the limit are looked at once.
        cell = (characters[window] - begins[owners[window]] - offset + span) // (index.limits[item] // 2 + 1)
        cells.append(np.unique((owners[window] * len(index.items) + item) * (2 * span) + cell))
    pair, cell = np.divmod(np.unique(np.concatenate(cells)), 2 * span)
    owner, item = np.divmod(pair, len(index.items))
    limit = index.limits[item]
    at = cell * (limit // 2 + 1) - span
    low = np.maximum(at - limit - 2, 0) + begins[owner]
    high = np.minimum(at + index.sizes[item] + limit + limit // 2 + 2 + begins[owner], ends[owner] - 1)
    folded = np.concatenate([_folded(s + "\0") for s in strings])
    slack = 2 * limit + limit // 2 + 4
    kept = np.flatnonzero(bounds(index, item, folded, low, np.maximum(high, low), slack))
    found: list[tuple[int, int, int, int, int]] = []
    last, covered = None, -1
    for o, n, place in zip(owner[kept].tolist(), item[kept].tolist(), at[kept].tolist()):
        if (o, n) != last:
            last, covered = (o, n), -1
        if place < covered:
            continue
        hit = verify(index.items[n][1], int(index.limits[n]), strings[o], place)
        # The look may reach back into the place before.
        if hit and hit[1] >= covered:
            found.append((o, n, *hit))
            covered = hit[2]
    return found


def _blocks(items: DataFrame, item_key: str, item_text: str, block_items: int, share: float) -> Iterator[Index]:
    """Indexes of blocks of the items; each block is read to the driver on its own."""
    asked = items.select(F.col(item_key), F.col(item_text).alias("__item")).where(F.length(F.trim("__item")) > 0)
    blocks = max(1, -(-asked.count() // block_items))
    number = F.pmod(F.xxhash64(item_key, "__item"), F.lit(blocks))
    for block in range(blocks):
        rows = [(r[0], normalise(r[1])) for r in asked.where(number == block).collect()]
        yield Index([r for r in rows if r[1]], share)


def _searched(index: Index, texts: Iterator[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """What ``search_texts`` finds, for texts taken a few at a time."""
    held: list[list[str]] = []
    numbers: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if text:
            held.append(normalise(text))
            numbers.append(i)
            size += len(text)
        if size > _SLICE_BYTES:
            yield from ((numbers[f[0]], *f[1:]) for f in search_texts(index, held))
            held, numbers, size = [], [], 0
    if held:
        yield from ((numbers[f[0]], *f[1:]) for f in search_texts(index, held))


def find(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``(key, item_key, distance, start, end)``: each place of a document that is an item but for a share of edits.

    Places are in characters of the document in lower case with collapsed white
    space. Overlapping places of the same item are reported once.
    """
    integer = T.IntegerType()
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField(item_key, items.schema[item_key].dataType),
            *(T.StructField(name, integer) for name in ("distance", "start", "end")),
        ]
    )
    bound_batches(docs.sparkSession)
    source = docs.select(key, F.col(text).alias("__text"))
    item_type = pa.int64() if isinstance(schema[1].dataType, T.LongType) else None
    out = None
    for index in _blocks(items, item_key, item_text, block_items, share):
        shared = ship(docs.sparkSession, index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared()
            names = [n for n, _ in known.items]
            for batch in batches:
                found = list(_searched(known, (v.as_py() for v in batch.column(1))))
                if found:
                    owner, item, *places = zip(*found)
                    columns = [
                        batch.column(0).take(pa.array(owner)),
                        pa.array([names[i] for i in item], item_type),
                        *(pa.array(p, pa.int32()) for p in places),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[key, item_key, "distance", "start", "end"])

        found = source.mapInArrow(work, schema)
        out = found if out is None else out.unionByName(found)
    return out


def mark(
    docs: DataFrame,
    items: DataFrame,
    into: str,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Rows of ``docs`` with the number of places found in each, so that no row needs a join to be judged."""
    out = docs.withColumn(into, F.lit(0))
    for index in _blocks(items, item_key, item_text, block_items, share):
        shared = ship(docs.sparkSession, index)

        def factory(shared=shared):
            known = shared()

            def run(texts: list) -> list:
                counts = [0] * len(texts)
                for owner, *_ in _searched(known, iter(texts)):
                    counts[owner] += 1
                return [counts]

            return run

        once = append(out, text, [T.StructField("__found", T.IntegerType())], factory)
        out = once.withColumn(into, F.col(into) + F.col("__found")).drop("__found")
    return out
