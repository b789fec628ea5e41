"""Language identification by naive Bayes over hashed character n-grams.

Training counts the n-grams of a bounded, evenly drawn sample of labelled
documents per language; the matrix of log-probabilities (buckets x languages,
bounded by ``BITS`` and ``MAX_LANGUAGES``) is broadcast. Scoring treats each
text as a sparse count vector: the rows of the matrix that its n-grams name are
gathered and summed per text in numpy. Neither step shuffles texts other than
the sample.

Null texts and texts without a letter get ``und`` and score 0, so does every
text if there was nothing to learn from. Equal posteriors go to the language
that sorts first. Texts of any length are read whole, in bounded pieces.
Repeated rows are predicted alike, an empty table gives an empty result, and a
column named like a new one is replaced by it. More than ``MAX_LANGUAGES``
labels are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rows

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
BITS = 16
# Labelled documents learnt from per language; fewer are all used.
SAMPLE_PER_LANGUAGE = 4000
MAX_LANGUAGES = 256
SMOOTHING = 0.1
_PARTS = 8
_PIECE = 1 << 17  # characters hashed at a time
_PAD = max(ORDERS) - 1


@dataclass
class Model:
    """``matrix[bucket, i]`` is the log-probability of a bucket in ``languages[i]``."""

    languages: list[str]
    matrix: np.ndarray
    prior: np.ndarray


def _folded() -> np.ndarray:
    """ASCII: letters stay, everything else counts as a space."""
    table = np.full(128, 32, np.uint64)
    for c in range(128):
        if chr(c).isalpha():
            table[c] = c
    return table


_FOLD = _folded()


def pieces(texts: list):
    """Texts as code points: ``(codes, starts of texts, numbers of texts)``.

    ``codes`` ends with ``_PAD`` characters that no n-gram starts at: the next
    ones of a text that is cut here, or zeros. Zeros also end each text.
    """
    codes: list[np.ndarray] = []
    owners: list[int] = []
    starts: list[int] = []
    size = 0

    def flush():
        joined = np.concatenate([*codes, np.zeros(_PAD, np.uint64)])
        return joined, np.array(starts), np.array(owners)

    for i, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        ascii_ = raw < 128
        raw[ascii_] = _FOLD[raw[ascii_]]
        for at in range(0, raw.size, _PIECE):
            tail = raw[at + _PIECE : at + _PIECE + _PAD]
            part = raw[at : at + _PIECE]
            if size and size + part.size > _PIECE:
                yield flush()
                codes, owners, starts, size = [], [], [], 0
            if tail.size:  # a long text goes on: its piece stands alone
                pad = np.zeros(_PAD - tail.size, np.uint64)
                yield np.concatenate([part, tail, pad]), np.array([0]), np.array([i])
                continue
            owners.append(i)
            starts.append(size)
            codes += [part, np.zeros(_PAD, np.uint64)]
            size += part.size + _PAD
    if size:
        yield flush()


def buckets(codes: np.ndarray):
    """For each n-gram length, the bucket of the n-gram that starts at each place."""
    n = codes.size - _PAD
    h = np.zeros(n, np.uint64)
    for order in range(1, max(ORDERS) + 1):
        h = (h + codes[order - 1 : order - 1 + n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if order in ORDERS:
            yield ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


def sample(docs: DataFrame, label: Column, key: Column, per_label: int, max_labels: int) -> DataFrame | None:
    """At most about ``per_label`` rows of each label, drawn by the hash of ``key``.

    Rare labels are used whole. The label is returned as ``__label``.
    """
    labelled = docs.withColumn("__label", label).where(F.col("__label").isNotNull())
    found = labelled.groupBy("__label").count().limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not found:
        return None
    grain = 1 << 30
    shares = [x for r in found for x in (F.lit(r[0]), F.lit(min(grain, grain * per_label // r[1])))]
    drawn = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(grain)) < F.create_map(*shares)[F.col("__label")]
    return labelled.where(drawn)


def train(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model | None:
    """Learn from the rows of ``docs`` where ``learn`` holds and ``lang`` is set; ``None`` if there are none."""
    usable = docs.where(learn & F.col(text).isNotNull())
    drawn = sample(usable, F.col(lang), F.col(key), per_language, MAX_LANGUAGES)
    if drawn is None:
        return None
    size = 1 << BITS

    def count(batches):
        counts: dict[str, list] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, rows.SLICE):
                part = batch.slice(at, rows.SLICE)
                langs = part.column(0).to_pylist()
                names = sorted(set(langs))
                texts = part.column(1).to_pylist()
                for name in names:
                    own = [t for t, l in zip(texts, langs) if l == name]
                    total = counts.setdefault(name, [np.zeros(size, np.int64), 0])
                    total[1] += len(own)
                    for codes, _, _ in pieces(own):
                        live = codes[: codes.size - _PAD] > 0
                        for b in buckets(codes):
                            total[0] += np.bincount(b[live], minlength=size)
        for name, (vector, n) in counts.items():
            yield pa.RecordBatch.from_pydict({"lang": [name], "n": [n], "counts": [vector.tobytes()]})

    # A bounded sample in a fixed number of parts: at most _PARTS vectors per language come back.
    spread = drawn.select("__label", text).repartition(_PARTS)
    total: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for row in spread.mapInArrow(count, "lang string, n bigint, counts binary").toLocalIterator():
        total[row[0]] = total.get(row[0], 0) + np.frombuffer(row[2], np.int64)
        texts[row[0]] = texts.get(row[0], 0) + row[1]
    languages = sorted(total)
    if not languages:
        return None
    counts = np.stack([total[x] for x in languages], axis=1).astype(np.float64) + SMOOTHING
    prior = np.array([texts[x] for x in languages], np.float64)
    return Model(languages, np.log(counts / counts.sum(axis=0)), np.log(prior / prior.sum()))


def log_likelihoods(texts: list, model: Model) -> np.ndarray:
    """``texts x languages``: summed log-probabilities of all n-grams, prior included."""
    out = np.tile(model.prior, (len(texts), 1))
    for codes, starts, owners in pieces(texts):
        dead = codes[: codes.size - _PAD] == 0
        total = 0.0
        for b in buckets(codes):
            gathered = model.matrix[b]
            gathered[dead] = 0.0
            total = total + np.add.reduceat(gathered, starts, axis=0)
        out[owners] += total
    return out


def predict(
    docs: DataFrame,
    model: Model | None,
    text: str = "text",
    keep: list[str] | None = None,
    into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """Rows of ``docs`` with the predicted language and its posterior probability."""
    fields = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    shared = rows.ship(docs.sparkSession, model)

    def factory():
        known = shared()

        def run(texts: list) -> list:
            spelled = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            if known is None:
                return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
            scores = log_likelihoods(texts, known)
            best = scores.argmax(axis=1)
            top = 1.0 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            return [
                [known.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), spelled)],
                [p if ok else 0.0 for p, ok in zip(top.tolist(), spelled)],
            ]

        return run

    return rows.append(docs, text, fields, factory, keep)
