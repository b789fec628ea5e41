"""Materialised intermediate tables.

A staged table is plain Parquet in the folder the cluster names in
``spark.checkpoint.dir``. It cuts lineage, so a lost executor costs only the
tasks it ran, and it lets later readers prune columns, which a row-format
checkpoint would not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side with at most so many rows, and bytes of text in them, may be broadcast.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
# Size estimates from here on mean that Catalyst knows nothing.
_UNKNOWN_BYTES = 1 << 58


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables, visible to every executor."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        # "local-cluster" has executors with folders of their own.
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spanseek-"))
    return context.getCheckpointDir()


# Folders handed out in each open scope, innermost last.
_SCOPES: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/spanseek-{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the folders that were staged in it.

    Results must be written or collected inside the block: they read the
    staged tables until then.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows with ``max_bytes`` of text, by counting no further than that.

    ``df`` should be stored or staged, so that its lineage does not run twice.
    """
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    size = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)).cast("bigint")
    rows, held = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; otherwise leave the join to Catalyst.

    Beyond the bound a shuffle join runs, with AQE splitting skewed keys.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """How many partitions of about ``bytes_each`` the rows of ``df`` fill.

    From Catalyst's estimate, which for stored tables is the size of the files;
    at least ``spark.sql.shuffle.partitions``. Rows that do not come from files
    have no estimate (Catalyst then assumes the largest number) and get just that.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    needed = -(-size // bytes_each) if size < _UNKNOWN_BYTES else 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), needed)


def spread_if_narrow(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a scan over the cores if its files give fewer splits than there are cores.

    For per-row work that is heavy on the processor, such as tokenising. A
    large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
