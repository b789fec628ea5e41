"""Embeddings and nearest neighbours.

Exact search compares every query with every vector, but never forms the
pairs as rows: a task multiplies its Arrow batches of vectors with the query
matrix, keeps the best k per query and gives them out once. Approximate search
does the same within the trained cells a query looks into. Queries reach the tasks in
blocks, each a broadcast of bounded size; vectors do not move, and the rows do
not depend on the size of a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EMBED_BATCH, HASH_DIMENSIONS
from ..folding import once_per_text
from ..functions import corpus_tokens
from ..staging import stage

# Embedder plug-in: called once per Python worker, returns texts -> matrix.
EmbedFactory = Callable[[], Callable[[list[str]], np.ndarray]]

# Queries are broadcast in blocks of this size (numbers, 8 bytes each).
MAX_QUERY_NUMBERS = 8_000_000
# Trained cells: how many for the root of the number of rows, and at most.
CELLS_PER_ROOT = 16
MAX_CELLS = 16_384
# Numbers in the sample cells are trained on, rows of it per cell, and rounds of training.
SAMPLE_NUMBERS = 8_000_000
ROWS_PER_CELL = 6
TRAIN_ROUNDS = 4
# A query is compared with this share of the rows, or with so many rows.
PROBED_SHARE = 0.25
LEAST_ROWS = 4096
# More cells than this are not listed in the filter of a scan.
_MAX_LISTED_CELLS = 10_000
_QUERY_BLOCK = 256
# Rows of a batch that are embedded or compared at a time.
_SLICE_ROWS = 1024
_DECIMALS = 6

# --- embedding ---------------------------------------------------------------


def _bucket(token: str) -> int:
    """First 32 bits of the token's MD5, modulo the dimension."""
    return int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % HASH_DIMENSIONS


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _unit_histogram(tokens: pa.Array) -> pa.Array:
    """Tokens counted per bucket, scaled to length 1 (all zero for no tokens).

    A slice of the rows at a time, so that a batch of long texts takes little memory.
    """
    slices = [_histogram_slice(tokens.slice(at, _SLICE_ROWS)) for at in range(0, len(tokens), _SLICE_ROWS)]
    return pa.concat_arrays(slices) if slices else pa.array([], pa.list_(pa.float32()))


def _histogram_slice(tokens: pa.Array) -> pa.Array:
    """Each distinct token is hashed once."""
    rows, width = len(tokens), HASH_DIMENSIONS
    coded = tokens.flatten().dictionary_encode()
    bucket_of = np.fromiter(map(_bucket, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    cells = np.repeat(np.arange(rows) * width, sizes) + bucket_of[coded.indices.to_numpy()]
    counts = np.bincount(cells, minlength=rows * width).reshape(rows, width).astype(np.float64)
    length = np.sqrt((counts**2).sum(axis=1, keepdims=True))
    unit = np.divide(counts, length, out=np.zeros_like(counts), where=length > 0)
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(unit.astype(np.float32).ravel()))


def embed_text(
    df: DataFrame, column: str, embed_factory: EmbedFactory | None = None, output: str = "embedding"
) -> DataFrame:
    """Add an ``array<float>`` embedding of a text column, documents and queries alike.

    ``embed_factory`` builds the caller's model once per Python worker; it gets
    texts in batches, each distinct text once, so that copies in a corpus cost
    nothing. Without one, a hashed bag of words of unit length is used. ``df``
    is read twice for a model and should be stored.
    """
    if embed_factory is None:
        return df.withColumn(output, _unit_histogram(corpus_tokens(F.col(column), drop_stop_words=False)))

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = embed_factory()
        for texts in batches:
            rows: list[np.ndarray] = []
            for at in range(0, len(texts), EMBED_BATCH):
                part = texts.iloc[at : at + EMBED_BATCH].tolist()
                rows.extend(np.asarray(model(part), dtype=np.float32))
            yield pd.Series(rows)

    return once_per_text(df, column, lambda distinct: distinct.withColumn(output, embed(F.col(column))), output)


def scalar_metadata(df: DataFrame) -> DataFrame:
    """Keep string, number and boolean columns, turn all others into text."""
    keep = (T.StringType, T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType)
    nested = (T.ArrayType, T.MapType, T.StructType)

    def as_scalar(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, keep):
            return column
        if isinstance(field.dataType, nested):
            return F.to_json(column).alias(field.name)
        return column.cast("string").alias(field.name)

    return df.select(*[as_scalar(field) for field in df.schema.fields])


# --- the kernel ---------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column to a float64 matrix; all rows must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) == 0:
        return flat.reshape(0, 0)
    width, rest = divmod(len(flat), len(column))
    if rest or column.null_count:
        raise ValueError("embeddings must be present and of one length")
    return flat.reshape(len(column), width)


def _distances(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
        dots = queries @ vectors.T
        distance = 1.0 - np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)
    else:
        distance = (
            (queries**2).sum(axis=1)[:, None]
            + (vectors**2).sum(axis=1)[None, :]
            - 2.0 * (queries @ vectors.T)
        )
    # Rounded once, here: every later comparison sees the same numbers.
    # Adding zero turns -0.0 into 0.0.
    return np.round(np.maximum(distance, 0.0), _DECIMALS) + 0.0


def _best_rows(distance: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest distances; equal ones by ``order``."""
    if len(distance) > k:
        limit = np.partition(distance, k - 1)[k - 1]
        near = np.flatnonzero(distance <= limit)
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((order[near], distance[near]))][:k]


class _RunningBest:
    """The k best rows per query over the batches of a task."""

    def __init__(self, ids: pa.Array, queries: np.ndarray, keys: list[str], k: int, metric: str, askers=None) -> None:
        self._ids, self._queries, self._keys, self._k, self._metric = ids, queries, keys, k, metric
        self._limits = np.full(len(queries), np.inf)
        self._best: pa.Table | None = None
        # Which queries look into a cell, a bit each; without them one cell holds all rows and queries.
        self._askers: np.ndarray | None = askers

    def _groups(self, batch: pa.RecordBatch):
        """Row numbers and query numbers that meet."""
        if self._askers is None:
            yield np.arange(batch.num_rows), np.arange(len(self._queries))
            return
        cells = batch.column("cell").to_numpy()
        order = np.argsort(cells, kind="stable")
        found, starts = np.unique(cells[order], return_index=True)
        for cell, rows in zip(found.tolist(), np.split(order, starts[1:])):
            askers = np.flatnonzero(np.unpackbits(self._askers[cell], count=len(self._queries)))
            if len(askers):
                yield rows, askers

    def add(self, batch: pa.RecordBatch) -> None:
        for at in range(0, batch.num_rows, _SLICE_ROWS):
            self._add_slice(batch.slice(at, _SLICE_ROWS))

    def _add_slice(self, batch: pa.RecordBatch) -> None:
        if batch.num_rows == 0 or len(self._queries) == 0:
            return
        matrix = _matrix(batch.column("embedding"))
        owners, rows, values = [], [], []
        for own, askers in self._groups(batch):
            for at in range(0, len(askers), _QUERY_BLOCK):
                block = askers[at : at + _QUERY_BLOCK]
                distance = _distances(self._queries[block], matrix[own], self._metric)
                limit = self._limits[block]
                if distance.shape[1] > self._k:
                    limit = np.minimum(limit, np.partition(distance, self._k - 1, axis=1)[:, self._k - 1])
                query, row = np.nonzero(distance <= limit[:, None])
                owners.append(block[query])
                rows.append(own[row])
                values.append(distance[query, row])
        if not owners:
            return
        owner, row, value = (np.concatenate(x) for x in (owners, rows, values))
        found = batch.select(self._keys).take(pa.array(row))
        table = pa.table([pa.array(owner), *found.columns, pa.array(value)], names=["owner", *self._keys, "distance"])
        self._cut(table if self._best is None else pa.concat_tables([self._best, table]))

    def _cut(self, table: pa.Table) -> None:
        names = ["owner", "distance", *self._keys]
        table = table.take(pc.sort_indices(table, sort_keys=[(n, "ascending") for n in names]))
        owner = table.column("owner").to_numpy()
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        self._best = table.filter(pa.array(place < self._k)).combine_chunks()
        full = np.flatnonzero(place == self._k - 1)
        self._limits[owner[full]] = table.column("distance").to_numpy()[full]

    def batches(self) -> Iterator[pa.RecordBatch]:
        """At most k rows per query, once per task."""
        if self._best is not None:
            named = self._ids.take(self._best.column("owner").combine_chunks())
            columns = [named, *(self._best.column(n) for n in (*self._keys, "distance"))]
            yield from pa.table(columns, names=["query_id", *self._keys, "distance"]).to_batches()


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    nearest = W.partitionBy("query_id").orderBy("distance", *keys)
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def _found_schema(queries: DataFrame, vectors: DataFrame, keys: list[str]) -> T.StructType:
    fields = [T.StructField("query_id", queries.schema["query_id"].dataType)]
    fields += [T.StructField(key, vectors.schema[key].dataType) for key in keys]
    return T.StructType([*fields, T.StructField("distance", T.DoubleType())])


# --- search in blocks of queries ------------------------------------------------


def _query_blocks(queries: DataFrame, max_numbers: int, probes: Column | None = None, n_cells: int = 0) -> Iterator[pa.Table]:
    """The queries in blocks of about ``max_numbers`` numbers, 64 bits of ``probes`` counted as one.

    They are stored first, so that a model embeds them once. ``probes`` is a
    column with a bit for each of ``n_cells`` cells, computed block by block.
    """
    stored = stage(queries.select("query_id", "embedding"), "queries")
    n_rows, width = stored.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    blocks = max(1, -(-n_rows * (max(1, width) + -(-n_cells // 64)) // max_numbers))
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for block in range(blocks):
        part = stored.where(number == block) if blocks > 1 else stored
        yield (part if probes is None else part.withColumn("probes", probes)).toArrow()


def _search(blocks, vectors: DataFrame, keys: list[str], k: int, metric: str, schema: T.StructType) -> DataFrame:
    """Each block of queries is broadcast and meets the vectors where they are; each is cut by itself.

    ``blocks`` gives queries, the columns to read and who looks into which cell.
    """
    out = []
    for table, read, askers in blocks:
        ids = table.column("query_id").combine_chunks()
        shared = vectors.sparkSession.sparkContext.broadcast((ids.to_pylist(), _matrix(table.column("embedding")), askers))
        id_type = table.schema.field("query_id").type

        def search(batches: Iterator[pa.RecordBatch], shared=shared, id_type=id_type) -> Iterator[pa.RecordBatch]:
            ids, matrix, askers = shared.value
            best = _RunningBest(pa.array(ids, id_type), matrix, keys, k, metric, askers)
            for batch in batches:
                best.add(batch)
            yield from best.batches()

        out.append(_top(read.mapInArrow(search, schema), keys, k))
    return reduce(DataFrame.unionByName, out)


def knn(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    metric: str = "l2",
    keys: list[str] | None = None,
    max_query_numbers: int = MAX_QUERY_NUMBERS,
) -> DataFrame:
    """The ``k`` nearest vectors of each query: ``query_id``, keys, distance, rank.

    ``queries`` is ``(query_id, embedding)``, ``vectors`` has an ``embedding``
    and the columns ``keys`` that identify a row. ``l2`` is the squared
    distance. Distances are rounded to six decimals; equal ones go by key.
    Vectors never move: a task keeps its k best rows per query and gives them
    out once. ``k`` above ``spark.sql.optimizer.windowGroupLimitThreshold``
    gives the same rows.
    """
    keys = keys or ["vec_id"]
    read = vectors.select(*keys, "embedding")
    blocks = ((table, read, None) for table in _query_blocks(queries, max_query_numbers))
    return _search(blocks, vectors, keys, k, metric, _found_schema(queries, vectors, keys))


# --- approximate search ---------------------------------------------------------


@dataclass(frozen=True)
class CellIndex:
    """Vectors sorted into trained cells.

    ``vectors`` has keys, ``embedding`` and ``cell``; ``cells`` is ``(cell,
    centre)`` and ``places`` ``(file, cell, rows)``, both of bounded size.
    ``read`` opens some of the files.
    """

    vectors: DataFrame
    cells: DataFrame
    places: DataFrame
    metric: str
    read: Callable[[list[str]], DataFrame]


def _placed(matrix: np.ndarray, metric: str) -> np.ndarray:
    """Vectors as cells see them: directions for ``cosine``."""
    if metric != "cosine":
        return matrix
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    # Single precision: a row between two centres may be in either cell.
    matrix, centres = matrix.astype(np.float32), centres.astype(np.float32)
    squares, turned = (centres**2).sum(axis=1), np.ascontiguousarray(-2.0 * centres.T)
    parts = [(squares + matrix[at : at + _QUERY_BLOCK] @ turned).argmin(axis=1) for at in range(0, len(matrix), _QUERY_BLOCK)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _k_means(matrix: np.ndarray, n_cells: int, rounds: int) -> np.ndarray:
    """Centres of ``matrix``, near ones next to each other; rows spread over it are the start."""
    place = np.arange(len(matrix))
    centres = matrix[(place + 1) * n_cells // len(matrix) > place * n_cells // len(matrix)].copy()
    for _ in range(rounds):
        owner = _nearest(matrix, centres)
        order = np.argsort(owner, kind="stable")
        held, starts = np.unique(owner[order], return_index=True)
        sums = np.add.reduceat(matrix[order], starts, axis=0)
        centres[held] = sums / np.diff(np.append(starts, len(order)))[:, None]
    middle = centres - centres.mean(axis=0)
    along = np.linalg.svd(middle, full_matrices=False)[2][0] if len(centres) > 1 else np.zeros(centres.shape[1])
    return centres[np.argsort(middle @ along, kind="stable")]


def train_cells(
    vectors: DataFrame,
    metric: str = "l2",
    n_cells: int | None = None,
    sample_numbers: int = SAMPLE_NUMBERS,
    rounds: int = TRAIN_ROUNDS,
    seed: int = 7,
) -> DataFrame:
    """``(cell, centre)`` of k-means over a sample of at most about ``sample_numbers`` numbers and ``ROWS_PER_CELL`` rows a cell.

    There are ``CELLS_PER_ROOT`` times as many cells as the root of the number
    of rows, with four rows each on average at least, and at most ``MAX_CELLS``.
    The sample is bounded, so one task trains on it, whatever the table's size.
    """
    stored = vectors.select("embedding")
    n_rows, width = stored.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    most = max(1, sample_numbers // max(1, width))
    wanted = n_cells or max(1, min(MAX_CELLS, most // 4, int(CELLS_PER_ROOT * n_rows**0.5), n_rows // 4))
    most = min(most, ROWS_PER_CELL * wanted)
    sample = stored if n_rows <= most else stored.sample(most / n_rows, seed)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b.column(0)) for b in batches if b.num_rows]
        if parts:
            matrix = _placed(np.concatenate(parts), metric)
            centres = _k_means(matrix, min(wanted, len(matrix)), rounds)
            cells = pa.array(np.arange(len(centres), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([cells, pa.array(list(centres), pa.list_(pa.float64()))], names=["cell", "centre"])

    return stage(sample.coalesce(1).mapInArrow(train, "cell int, centre array<double>"), "cells")


def _centres(cells: DataFrame) -> np.ndarray:
    """At most ``MAX_CELLS`` centres, in order of their cells."""
    table = cells.select("cell", "centre").toArrow().sort_by("cell")
    return _matrix(table.column("centre"))


def assign_cells(vectors: DataFrame, cells: DataFrame, metric: str = "l2") -> DataFrame:
    """Add ``cell``: the one with the nearest centre. Every row gets one."""
    shared = vectors.sparkSession.sparkContext.broadcast(_centres(cells))

    @F.arrow_udf("int")
    def cell(embedding: pa.Array) -> pa.Array:
        matrix = _matrix(embedding)
        return pa.array(_nearest(_placed(matrix, metric), shared.value) if len(matrix) else [], pa.int32())

    return vectors.withColumn("cell", cell(F.col("embedding")))


def _probes(queries: np.ndarray, centres: np.ndarray, sizes: np.ndarray, rows: float) -> tuple[np.ndarray, np.ndarray]:
    """``(query, cell)`` pairs: the nearest cells that hold at most ``rows`` rows together, and the nearest in any case."""
    squares, owners, cells = (centres**2).sum(axis=1), [], []
    for at in range(0, len(queries), _QUERY_BLOCK):
        block = queries[at : at + _QUERY_BLOCK]
        order = np.argsort(squares - 2.0 * (block @ centres.T), axis=1, kind="stable")
        taken = np.cumsum(sizes[order], axis=1) <= rows
        taken[:, 0] = True
        query, place = np.nonzero(taken)
        owners.append(query + at)
        cells.append(order[query, place])
    return (np.concatenate(owners), np.concatenate(cells)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _probe_bits(queries: np.ndarray, centres: np.ndarray, sizes: np.ndarray, rows: float) -> np.ndarray:
    """``_probes`` as a bit per cell, a row of bytes per query."""
    parts = []
    for at in range(0, len(queries), _QUERY_BLOCK):
        block = queries[at : at + _QUERY_BLOCK]
        probed = np.zeros((len(block), len(centres)), bool)
        probed[_probes(block, centres, sizes, rows)] = True
        parts.append(np.packbits(probed, axis=1))
    return np.concatenate(parts) if parts else np.zeros((0, -(-len(centres) // 8)), np.uint8)


def _askers(probes: pa.ChunkedArray, n_cells: int) -> np.ndarray:
    """The bits of ``_probe_bits`` turned: a bit per query, a row of bytes per cell."""
    out = np.zeros((n_cells, -(-len(probes) // 8)), np.uint8)
    for at in range(0, len(probes), _QUERY_BLOCK):
        rows = probes.slice(at, _QUERY_BLOCK).to_pylist()
        bits = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
        turned = np.packbits(np.unpackbits(bits, axis=1, count=n_cells), axis=0).T
        out[:, at // 8 : at // 8 + turned.shape[1]] = turned
    return out


def knn_lsh(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    keys: list[str] | None = None,
    share: float = PROBED_SHARE,
    max_query_numbers: int = MAX_QUERY_NUMBERS,
) -> DataFrame:
    """Approximate ``knn`` in the metric of the index: each query looks into its nearest cells only.

    These hold at most ``share`` of all rows, or ``LEAST_ROWS`` if that is more,
    so small tables are searched whole. Rows of the probed cells are compared
    exactly. Files without a probed cell are not opened, pages without one not
    read. A cell that holds a large share of the vectors is spread over several
    files, so no cell becomes one task's work. Cells are chosen in tasks over the
    queries; pairs of a query and a cell, which grow faster than either, are a
    bit each in the blocks. The rows do not depend on ``max_query_numbers``.
    """
    keys = keys or ["vec_id"]
    places = index.places.toArrow().to_pandas()
    centres = _centres(index.cells)
    sizes = np.zeros(len(centres), np.int64)
    np.add.at(sizes, places["cell"].to_numpy(), places["rows"].to_numpy())
    most = max(LEAST_ROWS, share * sizes.sum())
    metric, shared = index.metric, index.vectors.sparkSession.sparkContext.broadcast((centres, sizes, most))

    @F.arrow_udf("binary")
    def probes(embedding: pa.Array) -> pa.Array:
        bits = _probe_bits(_placed(_matrix(embedding), metric), *shared.value)
        return pa.array([row.tobytes() for row in bits], pa.binary())

    def blocks():
        chosen = probes(F.col("embedding")) if len(centres) else None
        for table in _query_blocks(queries, max_query_numbers, chosen, len(centres)):
            askers = None if chosen is None else _askers(table.column("probes"), len(centres))
            read = index.vectors
            if askers is not None:
                listed = np.flatnonzero(askers.any(axis=1))
                held = places["cell"].isin(listed)
                # Sorted by cell, a file holds few cells, so most files are left alone.
                if held.sum() < len(places):
                    read = index.read(sorted(set(places["file"][held]))) if held.any() else read.limit(0)
                    if len(listed) < _MAX_LISTED_CELLS:
                        read = read.where(F.col("cell").isin(listed.tolist()))
            yield table, read.select(*keys, "embedding", "cell"), askers

    return _search(blocks(), index.vectors, keys, k, index.metric, _found_schema(queries, index.vectors, keys))
