"""Chunk store, vector store and build state."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MTIME_TOLERANCE
from ..operators import lexical
from ..operators.vectors import CellIndex, assign_cells, train_cells
from ..schemas import chunk, ingest_state
from ..staging import partitions_for

_VERSIONS = "versions"
_VERSION_ROW = "version string, published long"
_VERSION_NAME = re.compile("^v([0-9]{20})-[0-9a-f]{8}$")
# Seconds after which a build that was not published counts as given up.
ABANDONED_AFTER = 7 * 24 * 3600.0
# Bytes of vectors per file, by the estimate of their size.
_FILE_BYTES = 128 << 20


def new_version() -> str:
    """A name for a version that tells when its build began and is used once."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a complete version current: one appended row, which is there whole or not at all."""
    row = spark.createDataFrame([(version, time.time_ns())], _VERSION_ROW)
    row.coalesce(1).write.mode("append").parquet(f"{path}/{_VERSIONS}")


def _published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_VERSION_ROW).parquet(f"{path}/{_VERSIONS}")


def current_version(spark: SparkSession, path: str) -> str:
    """The version published last, whenever its build began; without any, an error (``AnalysisException``)."""
    order = F.struct(F.coalesce("published", F.lit(0)), "version")
    return _published(spark, path).agg(F.max_by("version", order)).first()[0]


def remove_version(spark: SparkSession, path: str, version: str) -> None:
    """Delete the files of a version and the catalogue's entry of its index."""
    lexical.drop_index(spark, f"{path}/{version}/index")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{version}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_old_versions(spark: SparkSession, path: str, abandoned_after: float = ABANDONED_AFTER) -> None:
    """Delete all versions but the current one.

    Versions without publication are builds under way, or ones whose driver was
    lost: those that began more than ``abandoned_after`` seconds ago are deleted.
    """
    current = current_version(spark, path)
    done = {row["version"] for row in _published(spark, path).select("version").distinct().collect()}
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    limit = time.time_ns() - int(abandoned_after * 1e9)
    for name in names:
        began = _VERSION_NAME.match(name)
        if began and name != current and (name in done or int(began[1]) < limit):
            remove_version(spark, path, name)


def write_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """Replace the chunk store at ``path`` and return a reader of it."""
    chunks.write.mode("overwrite").parquet(path)
    return read_chunks(chunks.sparkSession, path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks as ``(file_path, first…, last…, content)``."""
    return spark.read.schema(chunk).parquet(path)


def write_vectors(vectors: DataFrame, path: str, metric: str = "l2", file_bytes: int = _FILE_BYTES) -> CellIndex:
    """Sort ``vectors`` into trained cells and store them at ``path`` in the order of the cells.

    One shuffle by range of (cell, key hash): a file holds few neighbouring
    cells, and a cell with very many vectors is cut over several files.
    ``cells`` (centres) and ``places`` (rows per file and cell) are small tables
    beside the ``data``. Overwrites: a second build leaves no rows of the first.
    """
    cells = train_cells(vectors, metric)
    cells.withColumn("metric", F.lit(metric)).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    files = partitions_for(vectors, file_bytes)
    spread = F.xxhash64(*vectors.columns)
    placed = assign_cells(vectors, cells, metric)
    ordered = placed.repartitionByRange(files, "cell", spread).sortWithinPartitions("cell")
    ordered.write.mode("overwrite").parquet(f"{path}/data")
    stored = vectors.sparkSession.read.schema(ordered.schema).parquet(f"{path}/data")
    places = stored.groupBy(F.col("_metadata.file_path").alias("file"), "cell").agg(F.count("*").alias("rows"))
    places.coalesce(1).write.mode("overwrite").parquet(f"{path}/places")
    return read_vectors(vectors.sparkSession, path)


def read_vectors(spark: SparkSession, path: str) -> CellIndex:
    """Open a vector store; a missing one is an error (``AnalysisException``)."""
    vectors = spark.read.parquet(f"{path}/data")
    cells = spark.read.parquet(f"{path}/cells")
    metric = cells.select("metric").first()

    def read(files: list[str]) -> DataFrame:
        return spark.read.schema(vectors.schema).parquet(*files)

    places = spark.read.schema("file string, cell int, rows long").parquet(f"{path}/places")
    return CellIndex(vectors, cells, places, metric[0] if metric else "l2", read)


def write_state(
    spark: SparkSession, path: str, max_chunk_size: int, extensions: list[str], root: str, newest_mtime: float
) -> None:
    """Remember what was built; to be called after a successful build only."""
    row = (max_chunk_size, list(extensions), root, float(newest_mtime))
    spark.createDataFrame([row], ingest_state).coalesce(1).write.mode("overwrite").json(path)


def index_is_fresh(
    spark: SparkSession, path: str, max_chunk_size: int, extensions: list[str], root: str, newest_mtime: float
) -> bool:
    """Whether the saved state equals the wanted one.

    No state, or another chunk size, suffix list or newest mtime: not fresh.
    Only another root, or a state that cannot be read: ``ValueError``.
    """
    try:
        saved = spark.read.schema(ingest_state).option("mode", "FAILFAST").json(path).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise ValueError(f"cannot read the state at {path}") from error
    except Exception as error:
        raise ValueError(f"cannot read the state at {path}") from error
    if saved is None or saved["max_chunk_size"] != max_chunk_size:
        return False
    if sorted(saved["extensions"] or []) != sorted(extensions):
        return False
    if saved["path"] != root:
        raise ValueError(f"the index was built from {saved['path']}")
    last = saved["last_modif"]
    return last is not None and abs(last - newest_mtime) < MTIME_TOLERANCE
