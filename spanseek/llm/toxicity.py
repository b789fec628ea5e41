"""Toxicity of texts after a noisy-channel decoder has undone disguises.

Words written with look-alike digits and signs, with letters spaced out or with
letters repeated, or several of these at once, become lattices: a sign may stand
for several letters or itself, a separator for nothing, a repeated letter for
one. Viterbi search finds the most probable letters under a character trigram
model of all documents (states: the last two letters). Other words have one path
only and stay. So do words whose only choice is a letter written twice, where
the model says it is meant twice: that choice depends on three letters and is
read from a table. More than six equal signs in a row, or more than a dozen
``*``, hide no word and stand as they are, so the work on a text is linear.

The restored words are scored: weights are log-odds of words and word beginnings
in toxic against other documents, learnt from bounded samples of the labelled
rows that may be learnt from; on labelled rows held apart, a logistic function
is fitted to the sum of a text's weights and to their share of its words. If one
of the two parts lacks a label, all rows that may be learnt from serve as both.

The trigram counts cover all documents; a task adds up its own before they are
shuffled, and their number is bounded by the alphabet. Null, empty and letterless
texts have weight zero and get the score of harmless text; without labels of
both kinds, as with empty tables, every score is 0. Repeated rows are scored
alike, texts of any length are read whole, and a column named like a new one is
replaced by it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rows
from .language import sample

# Labelled documents learnt from, per label and step.
SAMPLE_PER_LABEL = 10_000
BUCKET_BITS = 20
PREFIXES = (4, 5, 6, 7, 8, 9, 10)
LEAST_WEIGHT = 2.0
_PARTS = 8
_SLICE_BYTES = 1 << 20

# --- character model ------------------------------------------------------------

SYMBOLS = 64
_EDGE = 0  # before, between and after words
_OTHER_FROM = 27


def symbol(char: str) -> int:
    """a to z have numbers of their own, other letters share the rest, all else is an edge."""
    if "a" <= char <= "z":
        return ord(char) - 96
    return _OTHER_FROM + ord(char) % (SYMBOLS - _OTHER_FROM) if char.isalpha() else _EDGE


def _symbol_table() -> np.ndarray:
    return np.array([symbol(chr(c)) for c in range(1 << 16)], np.int64)


def count_trigrams(docs: DataFrame, text: str) -> np.ndarray:
    """Counts of symbol triples over all texts; at most ``SYMBOLS ** 3`` rows are returned to the driver."""
    size = SYMBOLS**3

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbol_table()
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = value.as_py()
                if not own:
                    continue
                codes = np.frombuffer(f" {own.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
                for at in range(0, codes.size - 2, 1 << 18):
                    s = table[np.minimum(codes[at : at + (1 << 18) + 2], 0xFFFF)]
                    triples = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
                    total += np.bincount(triples, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"triple": pa.array(found), "n": pa.array(total[found])})

    rows.bound_batches(docs.sparkSession)
    counts = docs.select(text).mapInArrow(work, "triple bigint, n bigint")
    out = np.zeros(size, np.float64)
    for triple, n in counts.groupBy("triple").agg(F.sum("n")).collect():
        out[triple] = n
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def log_probabilities(counts: np.ndarray, prior: float = 4.0) -> np.ndarray:
    """``[a, b, c]``: log-probability of c after a and b, shorter contexts mixed in."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + SYMBOLS)
    pairs = counts.sum(axis=0)
    two = (pairs + prior * one) / (pairs.sum(axis=1, keepdims=True) + prior)
    three = (counts + prior * two[None]) / (counts.sum(axis=2, keepdims=True) + prior)
    return np.log(three)


# --- the channel ------------------------------------------------------------------

# What a sign may stand for (fixed values).
LOOK_ALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "bg",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "*": "abcdefghijklmnopqrstuvwxyz",
}
_SEPARATORS = " .-_*"
# Signs that are marks at the end of a word, and between letters that stand alone.
_MARKS = "*|!"
_LETTER = r"[^\W\d_]"
_SIGNS = re.escape("".join(LOOK_ALIKES))
_FIRM = re.escape("".join(c for c in LOOK_ALIKES if c not in _MARKS))
_UNIT = rf"(?:{_LETTER}|[{_FIRM}])"
SUSPECT = re.compile(
    rf"(?<![\w{_FIRM}])(?P<spaced>{_UNIT}(?:[ .\-_*]+{_UNIT}){{2,}})(?![\w{_FIRM}])"
    rf"|{_LETTER}[{_SIGNS}]+(?={_LETTER})"
    rf"|{_LETTER}[{_FIRM}]+(?!\w)"
    rf"|(?<!\S)[{_SIGNS}]+(?={_LETTER})"
    rf"|(?P<again>{_LETTER})(?P=again)(?P<more>(?P=again)?)"
)
_BODY = re.compile(rf"(?:{_LETTER}|[{_SIGNS}])*")
_LONG_RUN = re.compile(rf"([{_SIGNS}])\1{{6}}")
_MOST_HIDDEN = 12
# Probabilities of writing what is meant: as it is, a letter as a sign, nothing as a separator or a third letter, a sign
# as itself; a letter twice instead of once; as itself a digit of a number at the end of a word, another sign there, a
# separator in a short row.
_KEEP, _SWAP, _DROP, _AS_IS = (math.log(p) for p in (0.9, 0.6, 0.5, 1e-4))
_TWICE, _NUMBER, _END, _SHORT = (math.log(p) for p in (0.002, 0.3, 0.01, 0.05))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character what may have been meant, with the log-probability of writing it so."""
    out = []
    run = 0
    end = len(token.rstrip("".join(LOOK_ALIKES)))
    at_end = _NUMBER if token[end:].isdigit() else _END
    # Three letters that stand alone may be just that; more rarely are.
    apart = _SHORT if len(token) <= 5 else _AS_IS
    for i, char in enumerate(token):
        run = run + 1 if i and token[i - 1] == char else 1
        if char.isalpha():
            # The third and later letters of a run stand for nothing; the second may, and does more often before a third.
            options = [("", _DROP)] if run > 2 else [(char, _KEEP)]
            if run == 2:
                options.append(("", _DROP if token[i + 1 : i + 2] == char else _TWICE))
        elif char in LOOK_ALIKES:
            meant = LOOK_ALIKES[char]
            options = [(c, _SWAP - math.log(len(meant))) for c in meant] + [(char, _AS_IS if i < end else at_end)]
            if char in _SEPARATORS:
                options.append(("", _AS_IS))
        elif char in _SEPARATORS:
            options = [("", _DROP), (char, apart)]
        else:
            options = [(char, _KEEP)]
        out.append(options)
    return out


def _without_marks(text: str, start: int, end: int) -> int:
    """Where a word ends, without marks and without three or more of one sign."""
    while end > start:
        sign, run = text[end - 1], end
        while run > start and text[run - 1] == sign:
            run -= 1
        if sign not in _MARKS and (sign.isalnum() or end - run < 3):
            break
        end = run
    return end


class Decoder:
    """Most probable readings of suspicious words, remembered per task."""

    MEMORY = 100_000

    def __init__(self, model: np.ndarray) -> None:
        self._model = model
        self._known: dict[str, str] = {}
        # [a, b, c]: between a and c, b written twice is meant once.
        twice = np.einsum("abb->ab", model)[:, :, None] + np.einsum("bbc->bc", model)[None]
        self._once = (model + _TWICE > twice + _KEEP).tolist()

    def decode(self, token: str) -> str:
        """Viterbi search through the lattice of ``token`` (lower case)."""
        model = self._model
        # state: the last two symbols -> (score, link to the reading before)
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(_EDGE, _EDGE): (0.0, None)}
        for options in lattice(token):
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, link) in best.items():
                for meant, cost in options:
                    if meant:
                        c = symbol(meant)
                        state, total, way = (b, c), score + cost + model[a, b, c], (link, meant)
                    else:
                        state, total, way = (a, b), score + cost, link
                    if state not in step or total > step[state][0]:
                        step[state] = (total, way)
            best = step
        _, link = max(((s + model[a, b, _EDGE], way) for (a, b), (s, way) in best.items()), key=lambda x: x[0])
        letters = []
        while link:
            link, meant = link
            letters.append(meant)
        return "".join(reversed(letters))

    def _stands(self, text: str, match: re.Match) -> bool:
        """Whether the letter that ``match`` found twice is meant twice."""
        start, end = match.span()
        before, after = text[start - 1 : start], text[end : end + 1]
        if before in LOOK_ALIKES or after in LOOK_ALIKES:
            return False
        once = self._once[symbol(before) if before else _EDGE][symbol(match["again"])]
        return not once[symbol(after) if after else _EDGE]

    def restore(self, text: str) -> str:
        """``text`` in lower case with suspicious words replaced by their readings."""
        text = text.lower()
        parts, at = [], 0
        for match in SUSPECT.finditer(text):
            if match.start() < at or match["again"] and not match["more"] and self._stands(text, match):
                continue
            if match["spaced"]:
                start, end = match.span()
                if sum(map(str.isalpha, match["spaced"])) < 2:
                    continue
            else:
                start = match.start()
                while start > at and (text[start - 1].isalpha() or text[start - 1] in LOOK_ALIKES):
                    start -= 1
                end = _BODY.match(text, match.start()).end()
                end = _without_marks(text, start, end)
                while start < end and text[start] in "*|!+":
                    start += 1
            token = text[start:end]
            if token.count("*") > _MOST_HIDDEN or _LONG_RUN.search(token):
                parts.append(text[at:end])
                at = end
                continue
            reading = self._known.get(token)
            if reading is None:
                reading = self.decode(token)
                if len(self._known) > self.MEMORY:
                    self._known.clear()
                if len(token) <= 40:
                    self._known[token] = reading
            parts += [text[at:start], reading]
            at = end
        return "".join([*parts, text[at:]]) if parts else text


# --- word weights -------------------------------------------------------------------


class Features:
    """Buckets of the words of texts: of the whole word and of its beginnings."""

    def __init__(self) -> None:
        letters = [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]
        self._words = rows.WordHasher(set(range(256)) - set(letters))
        self._shift = np.uint64(64 - BUCKET_BITS)

    def __call__(self, texts: list[str]):
        """``(buckets per feature, valid per feature, text number of each word)``."""
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(d) + 1 for d in data])
        joined = np.frombuffer(b" ".join([*data, b"\0" * max(PREFIXES)]), np.uint8)
        starts, ends, numbers = self._words(joined)
        owner = np.searchsorted(np.cumsum(sizes), starts, "right")
        h = np.zeros(starts.size, np.uint64)
        found, valid = [(numbers >> self._shift).astype(np.int64)], [np.ones(starts.size, bool)]
        for i in range(max(PREFIXES)):
            at = np.minimum(starts + i, joined.size - 1)
            h = (h + joined[at] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            if i + 1 in PREFIXES:
                found.append((rows.mix(h + np.uint64(i)) >> self._shift).astype(np.int64))
                valid.append(ends - starts > i + 1)
        return found, valid, owner


def slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _SLICE_BYTES):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


@dataclass
class Model:
    """Character model, word weights by bucket and the logistic function of a text's two figures."""

    characters: np.ndarray
    weights: np.ndarray
    logistic: np.ndarray


def figures(texts: list[str], features: Features, weights: np.ndarray) -> np.ndarray:
    """``texts x 2``: the sum of the weights of a text's words, and per word, both as logarithms."""
    out = np.zeros((len(texts), 2))
    for at, part in slices(texts):
        found, valid, owner = features(part)
        if not owner.size:
            continue
        weight = np.zeros(owner.size)
        for bucket, ok in zip(found, valid):
            np.maximum(weight, weights[bucket] * ok, out=weight)
        mass = np.bincount(owner, weight, len(part))
        words = np.bincount(owner, minlength=len(part))
        out[at : at + len(part), 0] = np.log1p(mass)
        out[at : at + len(part), 1] = np.log1p(1000 * mass / np.maximum(words, 1))
    return out


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column, per_label: int) -> DataFrame | None:
    drawn = sample(labels.where(learn).select(key, label), F.when(F.col(label).isin(0, 1), F.col(label).cast("int")), F.col(key), per_label, 2)
    if drawn is None:
        return None
    # A bounded sample of keys, small enough to broadcast at any size of the table.
    keys = drawn.select(F.col(key).alias("__key"), F.col("__label").alias("label")).distinct()
    return docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(keys), F.col(key) == F.col("__key")).select("text", "label").repartition(_PARTS)


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    hold: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_label: int = SAMPLE_PER_LABEL,
) -> Model | None:
    """Learn from the rows of ``labels`` where ``learn`` holds: weights where ``hold`` does not, the rest where it does."""
    characters = log_probabilities(count_trigrams(docs, text))

    def part(which: Column) -> DataFrame | None:
        return _labelled(docs, labels, key, text, label, which, per_label)

    parts = part(learn & ~hold), part(learn & hold)
    return _fit(docs, characters, *parts) or _fit(docs, characters, part(learn), part(learn))


def _fit(docs: DataFrame, characters: np.ndarray, first: DataFrame | None, second: DataFrame | None) -> Model | None:
    """Weights from ``first``, the logistic function from ``second``; ``None`` if one lacks a label."""
    if first is None or second is None:
        return None
    decoder = rows.ship(docs.sparkSession, characters)
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, features = Decoder(decoder()).restore, Features()
        total = np.zeros((2, size), np.int32)
        seen = [0, 0]
        for batch in batches:
            texts, given = [restore(t) for t in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist())
            for at, part in slices(texts):
                found, valid, owner = features(part)
                pairs = np.concatenate([owner[ok] * size + bucket[ok] for bucket, ok in zip(found, valid)])
                own, bucket = np.divmod(np.unique(pairs), size)
                for one in (0, 1):
                    total[one] += np.bincount(bucket[given[at + own] == one], minlength=size).astype(np.int32)
            for one in (0, 1):
                seen[one] += int((given == one).sum())
        for one in (0, 1):
            yield pa.RecordBatch.from_pydict({"label": [one], "n": [seen[one]], "counts": [total[one].tobytes()]})

    counts, seen = np.zeros((2, size)), np.zeros(2)
    # A fixed number of parts, so a fixed number of count vectors comes back.
    for row in first.mapInArrow(count, "label bigint, n bigint, counts binary").toLocalIterator():
        counts[row[0]] += np.frombuffer(row[2], np.int32)
        seen[row[0]] += row[1]
    if not seen.all():
        return None
    odds = np.log((counts[1] + 0.5) / (seen[1] + 1)) - np.log((counts[0] + 0.5) / (seen[0] + 1))
    odds -= np.sqrt(1 / (counts[1] + 0.5) + 1 / (counts[0] + 0.5))
    weights = np.where(odds >= LEAST_WEIGHT, odds, 0.0).astype(np.float32)
    shared = rows.ship(docs.sparkSession, weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, features, known = Decoder(decoder()).restore, Features(), shared()
        for batch in batches:
            x = figures([restore(t) for t in batch.column(0).to_pylist()], features, known)
            arrays = [pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column(1)]
            yield pa.RecordBatch.from_arrays(arrays, names=["mass", "density", "label"])

    points = np.array(second.mapInArrow(measure, "mass double, density double, label int").collect())
    if len(points) == 0 or len(set(points[:, 2])) < 2:
        return None
    order = np.lexsort(points.T)
    return Model(characters, weights, fit_logistic(points[order, :2], points[order, 2]))


def restore(docs: DataFrame, model: Model, text: str = "text", into: str = "restored") -> DataFrame:
    """Rows of ``docs`` with the restored text."""
    decoder = rows.ship(docs.sparkSession, model.characters)

    def factory():
        undo = Decoder(decoder()).restore
        return lambda texts: [[None if t is None else undo(t) for t in texts]]

    return rows.append(docs, text, [T.StructField(into, T.StringType())], factory)


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``score``: the probability that a label says toxic."""
    shared = rows.ship(docs.sparkSession, model)

    def factory():
        known = shared()
        if known is None:
            return lambda texts: [[0.0] * len(texts)]
        undo, features = Decoder(known.characters).restore, Features()

        def run(texts: list) -> list:
            x = figures([undo(t or "") for t in texts], features, known.weights)
            z = np.column_stack([x, np.ones(len(x))]) @ known.logistic
            return [(1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()]

        return run

    return rows.append(docs, text, [T.StructField("score", T.DoubleType())], factory, keep)
