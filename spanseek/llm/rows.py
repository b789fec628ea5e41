"""Row-wise work on texts in Arrow batches, shared by the operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Texts turned into Python strings at a time.
SLICE = 256
# Rows per Arrow batch.
BATCH_ROWS = 1024

TextsFunction = Callable[[list], list]


def ship(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast ``value`` with the code of its class; the result returns it in a task."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


def bound_batches(spark: SparkSession) -> None:
    """Lower the rows per Arrow batch to ``BATCH_ROWS``, unless the session sets a number of its own.

    Spark's default of 10,000 suits narrow rows; with texts a batch is many
    megabytes, several times over in each task.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def append(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    factory: Callable[[], TextsFunction],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` with ``fields`` computed from the column ``text``.

    ``factory`` runs once per task and returns a function from a list of texts
    (null: ``None``) to one list of values per field. The columns ``keep``
    (default: all) are passed through; one that has the name of a new field is
    replaced by it. Nothing is shuffled and memory is bounded by a batch.
    """
    bound_batches(df.sparkSession)
    new = {field.name.lower() for field in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    n = len(kept)
    # A text that is passed through travels once.
    at_text = kept.index(text) if text in kept else n
    source = df.select(*kept) if at_text < n else df.select(*kept, df[text].alias("__text"))
    schema = T.StructType([*source.schema.fields[:n], *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = factory()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = run(part.column(at_text).to_pylist())
                arrays = [pa.array(values, ARROW[field.dataType.simpleString()]) for values, field in zip(made, fields)]
                columns = [*part.columns[:n], *arrays]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:n], *(f.name for f in fields)])

    return source.mapInArrow(work, schema)


ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
}

_MASK = (1 << 64) - 1
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_BLOCK = 1 << 16


def _powers(root: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(root)
        np.multiply.accumulate(out, out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """64-bit numbers of the words of a UTF-8 text, equal for equal words.

    A word is a run of bytes other than separators (default: ASCII white
    space). The number is a polynomial in an odd base modulo 2**64, summed over
    all words at once.
    """

    def __init__(self, separators: set[int] = frozenset((0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))) -> None:
        self._space = np.zeros(256, bool)
        self._space[list(separators)] = True
        self._grow(_BLOCK)

    def _grow(self, n: int) -> None:
        self._up = _powers(_ROOT, n)
        self._down = _powers(_ROOT_INVERSE, n)

    def bounds(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end."""
        inside = np.zeros(data.size + 2, np.int8)
        inside[1:-1] = ~self._space[data]
        step = np.diff(inside)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, ends, numbers)`` of the words of ``data`` (uint8)."""
        starts, ends = self.bounds(data)
        if not starts.size:
            return starts, ends, np.zeros(0, np.uint64)
        if data.size > self._up.size:
            self._grow(1 << int(data.size).bit_length())
        terms = (data.astype(np.uint64) + np.uint64(1)) * self._up[: data.size]
        terms[self._space[data]] = 0
        return starts, ends, mix(np.add.reduceat(terms, starts) * self._down[starts])
