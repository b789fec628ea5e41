"""Alignment of two tokenisations of a text, and how often their tokens meet in the corpus.

Both tokenisers run over the whole text. Places where a token ends on both
sides and both next tokens begin with a space (each verified by its byte
offset) are anchors: they cut the two id sequences into windows, about one per
word. Inside a window the offsets at which both sides end a token cut it into
groups. A window is a function of its ids alone, so alignments are remembered
by the pair of id tuples and a word is aligned once, however often it occurs.

All tokens of a group are linked with each other. ``align`` also counts, for
each linked pair of ids, the documents of the corpus that hold it. A task keeps
a dictionary of the pairs of its last texts and gives each text as numbers in
it; only dictionaries, one row per pair and some megabytes of text, are
shuffled to be counted, and the counts come back to the texts by dictionary. So
a pair that is in every document is one row per dictionary, and nothing is
broadcast but the two vocabularies.

Null and empty texts, and texts that either side does not give back byte by
byte (a literal U+2581, say), have no tokens: numbers are 0, groups are empty.
A very long text is one row with as many windows; a window without anchors is
aligned in one pass over its tokens. Repeated rows, rows that share an id and
rows without one count as documents of their own. An empty table gives an empty
one. A kept column that has the name of a new one is replaced by it.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage
from . import rows
from .byte_bpe import to_bytes

# A dictionary is closed after so many tokens of both sides.
DICTIONARY_TOKENS = 4_000_000
# Windows remembered per task.
MEMORY = 400_000
# Longer windows (tokens of one side) are aligned anew each time.
REMEMBERED = 64
# Characters of texts that are aligned together.
SLICE_CHARS = 1_000_000
# Longer texts are not given to the library for ranks.
LONG = 200_000
# Fixed value: how a byte-level vocabulary cuts text before it merges.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "▁"
_RESULT = [
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()),
]
_INNER = [
    T.StructField("__dictionary", T.LongType()),
    T.StructField("__links", T.BinaryType()),
    T.StructField("__pairs", T.BinaryType()),
]


def piece_bytes(piece: str) -> bytes:
    """Bytes that a sentencepiece piece stands for."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_SPACE, " ").encode()


class Tokenizers:
    """The two vocabularies: a byte-level BPE in JSON (A) and a sentencepiece model (B)."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        with open(byte_level, encoding="utf-8") as file:
            self.byte_level = file.read()
        with open(pieces, "rb") as file:
            self.pieces = file.read()


class Encoder:
    """Ids of texts on both sides, ``None`` where the bytes of a side are not those of the text.

    Where the merges of A stand in the order of their ids, as is usual, its
    vocabulary is also one of ranks, and the faster library for ranks gives the
    same ids; very long texts are left to the library of the JSON file.
    """

    def __init__(self, vocabularies: Tokenizers) -> None:
        import sentencepiece

        self._json = vocabularies.byte_level
        self._whole = None
        self._b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces)
        described = json.loads(vocabularies.byte_level)
        added = {t["content"]: t["id"] for t in described["added_tokens"]}
        known = {t: n for t, n in described["model"]["vocab"].items() if t not in added}
        self.a = [b""] * (max([*known.values(), *added.values()]) + 1)
        for token, number in known.items():
            self.a[number] = to_bytes(token)
        for token, number in added.items():
            self.a[number] = token.encode()
        self._ranks = self._by_rank(described, known)
        self.b = [piece_bytes(p) for p in self._b.id_to_piece(list(range(self._b.get_piece_size())))]

    def _by_rank(self, described: dict, known: dict[str, int]):
        cut = described["pre_tokenizer"] or {}
        merged = [known.get(m.replace(" ", "", 1) if isinstance(m, str) else "".join(m), -1) for m in described["model"]["merges"]]
        ordered = len(merged) == len(known) - 256 and merged == sorted(known.values())[256:]
        plain = described["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not (ordered and plain):
            return None
        import tiktoken

        ranks = {self.a[number]: number for number in known.values()}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _first(self, text: str) -> list[int]:
        if self._ranks is not None and len(text) <= LONG:
            return self._ranks.encode_ordinary(text)
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_str(self._json)
            # strings of special tokens inside a text are ordinary text
            self._whole.encode_special_tokens = True
        return self._whole.encode(text, add_special_tokens=False).ids

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        held = [i for i, t in enumerate(texts) if t]
        out: list = [None] * len(texts)
        second = self._b.encode([texts[i] for i in held], num_threads=1)
        a, b = self.a.__getitem__, self.b.__getitem__
        for i, y in zip(held, second):
            text = " " + texts[i]
            x = self._first(text)
            data = text.encode("utf-8", "replace")
            if b"".join(map(a, x)) == data and b"".join(map(b, y)) == data:
                out[i] = (np.array(x, np.int32), np.array(y, np.int32))
        return out


class _Lists:
    """Numbered lists of numbers in one array."""

    def __init__(self) -> None:
        self.count = self.used = 0
        self._ends = np.zeros(1 << 12, np.int64)
        self._values = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= array.size else np.concatenate([array, np.zeros(max(size, array.size), array.dtype)])

    def extend(self, sizes: np.ndarray, values: np.ndarray) -> None:
        self._ends = self._room(self._ends, self.count + sizes.size)
        self._values = self._room(self._values, self.used + values.size)
        self._ends[self.count : self.count + sizes.size] = self.used + np.cumsum(sizes)
        self._values[self.used : self.used + values.size] = values
        self.count += sizes.size
        self.used += values.size

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of some lists, and their values one list after the other."""
        ends = self._ends[numbers]
        firsts = np.where(numbers > 0, self._ends[numbers - 1], 0)
        sizes = ends - firsts
        return sizes, self._values[_ranges(firsts, sizes)]


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``first … first + size - 1`` of all ranges."""
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Dictionary:
    """Windows, groups and id pairs of the texts of a task, numbered as they come.

    A window is known by its two id tuples and is a list of groups; a group is
    known by its ids and is a list of pairs.
    """

    def __init__(self, encoder: Encoder) -> None:
        self._sizes = tuple(np.array([len(t) for t in tokens], np.int64) for tokens in (encoder.a, encoder.b))
        self._spaced = tuple(np.array([t[:1] == b" " for t in tokens]) for tokens in (encoder.a, encoder.b))
        self.clear()

    def clear(self) -> None:
        self.tokens = 0
        self._windows: dict[bytes, int] = {}
        self._groups: dict[tuple[bytes, bytes], int] = {}
        self._text: list[str] = []
        self._of_window, self._of_group, self._times = _Lists(), _Lists(), _Lists()
        self._links = _Lists()
        self._pairs: dict[int, int] = {}
        self._held = np.zeros(1 << 12, np.int64)

    def _starts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = [np.cumsum(size[ids]) for size, ids in zip(self._sizes, (a, b))]
        return tuple(np.concatenate([[0], e[:-1]]) for e in ends)

    def _add_groups(self, keys: list[tuple[bytes, bytes]]) -> None:
        sizes, numbers, values, links = [], [], [], []
        pairs = self._pairs
        for key in keys:
            x, y = (np.frombuffer(side, np.int32).tolist() for side in key)
            times = {p << 32 | q: n * m for p, n in Counter(x).items() for q, m in Counter(y).items()}
            sizes.append(len(times))
            numbers += [pairs.setdefault(p, len(pairs)) for p in times]
            values += times.values()
            links.append(len(x) * len(y))
            self._groups[key] = len(self._text)
            self._text.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
        self._of_group.extend(np.array(sizes), np.array(numbers))
        self._times.extend(np.array(sizes), np.array(values))
        self._links.extend(np.ones(len(keys), np.int64), np.array(links))

    def _group_numbers(self, a: np.ndarray, b: np.ndarray, firsts: list[np.ndarray]) -> np.ndarray:
        """Numbers of the groups of two id sequences that begin at ``firsts``."""
        at_a, at_b = (np.append(f, ids.size) for f, ids in zip(firsts, (a, b)))
        numbers = np.empty(at_a.size - 1, np.int64)
        single = (np.diff(at_a) == 1) & (np.diff(at_b) == 1)
        pairs, back = np.unique(a[firsts[0][single]].astype(np.int64) << 32 | b[firsts[1][single]], return_inverse=True)
        ones = [(np.int32(p >> 32).tobytes(), np.int32(p & 0xFFFFFFFF).tobytes()) for p in pairs.tolist()]
        data_a, data_b, rest = a.tobytes(), b.tobytes(), np.flatnonzero(~single)
        bounds = [(at[rest + i] * 4).tolist() for at in (at_a, at_b) for i in (0, 1)]
        many = [(data_a[p:q], data_b[r:t]) for p, q, r, t in zip(*bounds)]
        known = self._groups
        new = [key for key in dict.fromkeys([*ones, *many]) if key not in known]
        if new:
            self._add_groups(new)
        numbers[single] = np.fromiter(map(known.__getitem__, ones), np.int64, len(ones))[back]
        numbers[rest] = np.fromiter(map(known.__getitem__, many), np.int64, len(many))
        return numbers

    def _add_windows(self, keys: list[bytes]) -> None:
        """Align windows: both sides end at the end of each, so they can be put one after the other."""
        ids = np.frombuffer(b"".join(keys), np.int32)
        of_a = ids >= 0
        a, b = ids[of_a], ~ids[~of_a]
        starts = self._starts(a, b)
        shared = np.intersect1d(*starts, assume_unique=True)
        firsts = [np.searchsorted(s, shared) for s in starts]
        # How many tokens of A, and then groups, begin before each window.
        ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys))) // 4
        tokens = np.concatenate([[0], np.cumsum(of_a)])[np.concatenate([[0], ends])]
        self._of_window.extend(np.diff(np.searchsorted(firsts[0], tokens)), self._group_numbers(a, b, firsts))

    def _window_numbers(self, keys: list[bytes]) -> np.ndarray:
        known = self._windows
        numbers = list(map(known.get, keys))
        if None in numbers:
            missing = list(dict.fromkeys(k for k, n in zip(keys, numbers) if n is None))
            first = self._of_window.count
            self._add_windows(missing)
            new = dict(zip(missing, range(first, first + len(missing))))
            numbers = [new[k] if n is None else n for k, n in zip(keys, numbers)]
            known.update(new)
            for key in missing:
                if len(key) > 8 * REMEMBERED:
                    del known[key]
        return np.array(numbers)

    def add(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, str, bytes]]:
        """Per text: numbers of groups and links, the groups in text, and the pairs with their times, packed."""
        # A text begins with a space on both sides, so it begins at an anchor and texts can be put one after the other.
        a, b = (np.concatenate(side) for side in zip(*texts))
        starts = self._starts(a, b)
        marked = [s[m[i]] for s, m, i in zip(starts, self._spaced, (a, b))]
        anchors = np.intersect1d(*marked, assume_unique=True)
        firsts = [np.searchsorted(s, anchors) for s in starts]
        # A window's key is its ids of A and, as negative numbers, of B.
        both = np.empty(a.size + b.size, np.int32)
        for side, ids, other in ((0, a, firsts[1]), (1, ~b, np.append(firsts[0][1:], a.size))):
            own = np.diff(np.append(firsts[side], ids.size))
            both[np.arange(ids.size) + np.repeat(other, own)] = ids
        data, bounds = both.tobytes(), ((firsts[0] + firsts[1]) * 4).tolist()
        keys = [data[p:q] for p, q in zip(bounds, [*bounds[1:], len(data)])]
        sizes, groups = self._of_window.get(self._window_numbers(keys))
        owner = np.searchsorted(np.cumsum([len(x) for x, _ in texts]), firsts[0], side="right")
        of_text = np.repeat(owner, sizes)
        n = len(texts)
        ends = np.cumsum(np.bincount(of_text, minlength=n)).tolist()
        links = np.zeros(n, np.int64)
        np.add.at(links, of_text, self._links.get(groups)[1])
        sizes, pairs = self._of_group.get(groups)
        _, times = self._times.get(groups)
        width = len(self._pairs)
        cells, back = np.unique(np.repeat(of_text, sizes) * width + pairs, return_inverse=True)
        total = np.zeros(cells.size, np.int64)
        np.add.at(total, back, times)
        pairs = cells % width
        if width > self._held.size:
            self._held = np.concatenate([self._held, np.zeros(width, np.int64)])
        np.add.at(self._held, pairs, 1)
        self.tokens += a.size + b.size
        cuts = np.searchsorted(cells, np.arange(n + 1) * width).tolist()
        shown = list(map(self._text.__getitem__, groups.tolist()))
        pairs, total = pairs.astype("<u4"), total.astype("<u8")
        out = []
        for i, (first, end) in enumerate(zip([0, *ends], ends)):
            packed = pairs[cuts[i] : cuts[i + 1]].tobytes() + total[cuts[i] : cuts[i + 1]].tobytes()
            out.append((end - first, int(links[i]), ";".join(shown[first:end]), packed))
        return out

    def close(self) -> bytes:
        """Per pair met since the last call: its number, the two ids and the texts that hold it."""
        met = np.flatnonzero(self._held)
        pairs = np.fromiter(self._pairs, np.int64, len(self._pairs))[met]
        packed = b"".join(column.astype("<i8").tobytes() for column in (met, pairs, self._held[met]))
        self.tokens = 0
        self._held[:] = 0
        if len(self._windows) > MEMORY:
            self.clear()
        return packed


def _slices(texts: list[str | None]) -> Iterator[slice]:
    """Texts that are aligned together: few, or one that is long."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_CHARS or i + 1 - first >= rows.SLICE or i + 1 == len(texts):
            yield slice(first, i + 1)
            first, size = i + 1, 0


def _tasks(docs: DataFrame, vocabularies: Tokenizers, text: str, keep: list[str]) -> DataFrame:
    """A row per text, with ``__links``, and a row per dictionary, with ``__pairs``."""
    rows.bound_batches(docs.sparkSession)
    new = {f.name.lower() for f in _RESULT + _INNER} | {"n_best", "count_sum"}
    kept = [c for c in keep if c.lower() not in new]
    source = docs.select(*kept, docs[text].alias("__text"))
    n = len(kept)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in source.schema.fields[:n]), *_RESULT, *_INNER])
    types = [rows.ARROW[f.dataType.simpleString()] for f in _RESULT + _INNER]
    names = [f.name for f in _RESULT + _INNER]
    shared = rows.ship(docs.sparkSession, vocabularies)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared())
        dictionary = Dictionary(encoder)
        number = TaskContext.get().partitionId() << 32
        made: pa.Schema | None = None

        def close() -> pa.RecordBatch:
            empty = [pa.nulls(1, field.type) for field in list(made)[:n]]
            values = [None, None, None, None, None, number, None, dictionary.close()]
            return pa.RecordBatch.from_arrays([*empty, *(pa.array([v], t) for v, t in zip(values, types))], schema=made)

        for batch in batches:
            if made is None:
                fields = [pa.field(f.name, f.type) for f in list(batch.schema)[:n]]
                made = pa.schema([*fields, *(pa.field(c, t) for c, t in zip(names, types))])
            texts = batch.column(n).to_pylist()
            for taken in _slices(texts):
                part = batch.slice(taken.start, taken.stop - taken.start)
                ids = encoder(texts[taken])
                held = [pair for pair in ids if pair]
                found = iter(dictionary.add(held) if held else ())
                out = []
                for pair in ids:
                    groups, links, shown, packed = next(found) if pair else (0, 0, "", b"")
                    lengths = (pair[0].size, pair[1].size) if pair else (0, 0)
                    out.append((*lengths, groups, links, shown, number, packed, None))
                columns = [pa.array(list(values), t) for values, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], schema=made)
                if dictionary.tokens >= DICTIONARY_TOKENS:
                    yield close()
                    number += 1
        if dictionary.tokens:
            yield close()

    return source.mapInArrow(work, schema)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            numbers, pairs, held = np.frombuffer(packed, "<i8").reshape(3, -1)
            for at in range(0, pairs.size, 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(pairs[part].size, number, np.int64)),
                        pa.array(numbers[part].astype(np.int32)),
                        pa.array((pairs[part] >> 32).astype(np.int32)),
                        pa.array((pairs[part] & 0xFFFFFFFF).astype(np.int32)),
                        pa.array(held[part]),
                    ],
                    names=["dictionary", "number", "a", "b", "held"],
                )


def _score(texts: pa.Table, found: pa.Table) -> pa.Table:
    """Sums over the links of each text of a dictionary."""
    order = found.column("number").to_numpy()
    count = np.zeros(int(order.max()) + 1 if order.size else 0, np.int64)
    best = np.zeros_like(count)
    count[order] = found.column("held").to_numpy()
    best[order] = found.column("best").to_numpy(zero_copy_only=False)
    sums = []
    for packed in texts.column("__links").to_pylist():
        n = len(packed) // 12
        pairs = np.frombuffer(packed, "<u4", n)
        times = np.frombuffer(packed, "<u8", n, 4 * n).astype(np.int64)
        sums.append((int((best[pairs] * times).sum()), int((count[pairs] * times).sum())))
    left = texts.drop_columns(["__links", "__dictionary"])
    for name, values in zip(("n_best", "count_sum"), zip(*sums) if sums else ((), ())):
        left = left.append_column(name, pa.array(values, pa.int64()))
    return left


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(dictionary, number, held, best)``: the documents of the corpus that hold each pair of a dictionary.

    ``best`` tells whether no other pair of its A id is held by more.
    """
    packed = aligned.where("__pairs IS NOT NULL").select("__dictionary", "__pairs")
    pairs = packed.mapInArrow(_unpack, "dictionary long, number int, a int, b int, held long")
    counts = pairs.groupBy("a", "b").agg(F.sum("held").alias("held"))
    # at most one row per id of B
    top = F.max("held").over(Window.partitionBy("a"))
    ranked = counts.select("a", "b", "held", (F.col("held") == top).alias("best"))
    return pairs.drop("held").join(ranked, ["a", "b"]).select("dictionary", "number", "held", "best")


def align(
    docs: DataFrame,
    vocabularies: Tokenizers,
    text: str = "text",
    keep: list[str] | None = None,
    groups: Callable[[Column], Column] = lambda shown: shown,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with their alignment.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count tokens, groups and
    linked occurrences, ``groups`` lists the ids as ``a1,a2|b1;a3|b2,b3``
    (``groups`` may name an expression of it to be stored instead),
    ``count_sum`` adds up the counts of the links, and ``n_best`` counts the
    links whose pair is the most frequent of its A id, ties included.
    """
    made = _tasks(docs, vocabularies, text, list(docs.columns) if keep is None else keep)
    shown = groups(F.col("groups"))
    made = stage(made.withColumn("groups", F.when(F.col("__pairs").isNull(), shown)), "alignment")
    texts = made.where("__pairs IS NULL").drop("__pairs")
    found = pair_counts(made)
    inner = {f.name for f in _INNER}
    result = [f for f in texts.schema.fields if f.name not in inner]
    schema = T.StructType([*result, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return texts.groupBy("__dictionary").cogroup(found.groupBy("dictionary")).applyInArrow(_score, schema)
