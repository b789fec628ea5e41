"""File trees as DataFrames.

Spark's file sources skip names that start with ``_`` or ``.``, such as
``__init__.py``, so trees are listed by tasks of their own. Listing and reading
are separate steps: directories are walked in parallel, filters on suffix or
name run on the listing alone, and only then are contents read, in partitions
hashed by path, so that one crowded directory does not become one task's work.

A walk goes in rounds. A task lists the directories it was dealt and those below
them, up to a number, and gives out the ones it has not come to, which are dealt
anew in the next round. So each directory is listed once, by one task, however
many entries it has, and the driver holds no names.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import file_listing
from ..staging import stage

_BATCH_BYTES = 16 << 20
_PARTITION_BYTES = 128 << 20
# Directories the driver expands to find enough work to hand out, and the most
# subdirectories it takes from one of them.
_MAX_EXPANDED = 10_000
_MAX_SUBDIRECTORIES = 100_000
# Directories a task of a walk lists on its own account, in the first round and in later ones.
_FIRST_DIRECTORIES = 64
_DIRECTORIES = 1024
_WALK_ROWS = 10_000
_WALKED = file_listing
_WALKED_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64()]


def _suffix(name: str) -> str:
    dot = name.rfind(".")
    return name[dot:] if 0 < dot < len(name) - 1 else ""


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """PyArrow's file system and path for a URI; Hadoop's names for S3 are those of one system."""
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def _entries(directory: str) -> Iterator[tuple[str, int | None, float | None]]:
    """Entries of one directory: ``(path, size, mtime)``, size ``None`` for a directory.

    Links to directories are not followed. A directory or file that cannot be
    read is passed over.
    """
    if directory.startswith("file://"):
        local = directory.removeprefix("file://")
        yield from (("file://" + path, size, mtime) for path, size, mtime in _entries(local))
        return
    if "://" in directory:
        system, base = _file_system(directory)
        scheme = directory[: len(directory.rstrip("/")) - len(base.rstrip("/"))]
        for info in system.get_file_info(pafs.FileSelector(base)):
            if info.type == pafs.FileType.Directory:
                yield scheme + info.path, None, None
            elif info.type == pafs.FileType.File:
                yield scheme + info.path, info.size, info.mtime_ns / 1e9
        return
    try:
        entries = os.scandir(directory)
    except OSError:
        return
    with entries:
        for entry in entries:
            try:
                if entry.is_dir(follow_symlinks=False):
                    found = entry.path, None, None
                elif entry.is_file():
                    status = entry.stat()
                    found = entry.path, status.st_size, status.st_mtime
                else:
                    continue
            except OSError:
                continue
            yield found


@dataclass
class _Subtree(InputPartition):
    directory: str
    recursive: bool


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/") or "/"
        self.tasks = int(options.get("tasks", "1000"))
        wanted = options.get("extensions")
        self.extensions = None if wanted is None else set(wanted.split("\n"))

    def partitions(self) -> list[InputPartition]:
        """Expand directories breadth-first until there is work for every task.

        The driver keeps directory names only, of which there is a bound; a
        directory with more subdirectories is one task's subtree.
        """
        parts, open_ = [], deque([self.root])
        while open_ and len(parts) < _MAX_EXPANDED and len(open_) < self.tasks:
            directory = open_.popleft()
            below = (path for path, size, _ in _entries(directory) if size is None)
            found = list(islice(below, _MAX_SUBDIRECTORIES + 1))
            if len(found) > _MAX_SUBDIRECTORIES:
                parts.append(_Subtree(directory, True))
            else:
                parts.append(_Subtree(directory, False))
                open_.extend(found)
        return parts + [_Subtree(directory, True) for directory in open_]

    def read(self, partition: _Subtree) -> Iterator[tuple]:
        todo = [partition.directory]
        while todo:
            for path, size, mtime in _entries(todo.pop()):
                if size is None:
                    if partition.recursive:
                        todo.append(path)
                    continue
                ext = _suffix(path.rsplit("/", 1)[-1])
                if self.extensions is None or ext in self.extensions:
                    yield path, path[len(self.root) :].lstrip("/"), ext, size, mtime


class FileTreeSource(DataSource):
    """``spark.read.format("filetree").load(root)``.

    Options: ``extensions``, exact suffixes joined by line breaks; ``tasks``,
    how many subtrees to aim for.
    """

    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self):
        return file_listing

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(self.options)


def list_tree(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """Every regular file below ``root``, hidden and ``_`` names included.

    ``root`` is a path all executors see, or a URI of a file system PyArrow
    knows. The suffix filter is exact and runs in the scan.
    """
    if "://" not in root and not os.path.isdir(root):
        raise ValueError(f"not a directory: {root}")
    root = root.rstrip("/") or "/"
    wanted = None if extensions is None else set(extensions)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed: list[DataFrame] = []
    todo, most = spark.createDataFrame([(root,)], "path string").coalesce(1), _FIRST_DIRECTORIES
    while True:
        found = stage(todo.mapInArrow(_walk(root, wanted, most), _WALKED), "walk")
        listed.append(found.where("size IS NOT NULL"))
        left = found.where("size IS NULL").select("path")
        if left.isEmpty():
            break
        todo, most = left.repartition(tasks), _DIRECTORIES
    return reduce(DataFrame.union, listed)


def _walk(root: str, wanted: set[str] | None, most: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(values), kind) for values, kind in zip(zip(*rows), _WALKED_TYPES)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=file_listing.fieldNames())

        todo = (path for dealt in batches for path in dealt.column(0).to_pylist())
        seen, below = 0, deque()
        while True:
            directory = below.popleft() if below else next(todo, None)
            if directory is None:
                break
            # What was dealt is listed in any case; what lies below it only up to a number.
            seen += 1
            for path, size, mtime in _entries(directory):
                ext = _suffix(path.rsplit("/", 1)[-1])
                if size is None and len(below) + seen < most:
                    below.append(path)
                elif size is None or wanted is None or ext in wanted:
                    rows.append((path, path[len(root) :].lstrip("/"), ext, size, mtime))
                if len(rows) >= _WALK_ROWS:
                    yield batch()
        if rows:
            yield batch()

    return walk


def _read(path: str) -> bytes | None:
    try:
        if "://" in path:
            system, name = _file_system(path)
            with system.open_input_stream(name) as stream:
                return stream.read()
        with open(path, "rb") as stream:
            return stream.read()
    except OSError:
        return None


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, mtimes, contents, held = [], [], [], 0
        for path, mtime in zip(*(column.to_pylist() for column in batch.columns)):
            content = _read(path)
            if content is None:
                continue
            paths.append(path)
            mtimes.append(mtime)
            contents.append(content)
            held += len(content)
            if held >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pydict({"path": paths, "mtime": mtimes, "content": contents})
                paths, mtimes, contents, held = [], [], [], 0
        if paths:
            yield pa.RecordBatch.from_pydict({"path": paths, "mtime": mtimes, "content": contents})


def read_contents(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(path, mtime, content)`` of listed files; unreadable ones give no row.

    The number of partitions follows the sizes in the listing, if it has them.
    It is explicit because the listing itself is tiny and adaptive coalescing
    would put all reading into one task.
    """
    if partitions is None:
        spark = files.sparkSession
        configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
        total = files.agg(F.sum("size")).first()[0] if "size" in files.columns else None
        needed = -(-(total or 0) // _PARTITION_BYTES)
        partitions = max(configured, spark.sparkContext.defaultParallelism, needed)
    spread = files.select("path", "mtime").repartition(partitions, "path")
    return spread.mapInArrow(_read_batches, "path string, mtime double, content binary")


def read_tree(
    spark: SparkSession, root: str, extensions: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """List, filter by suffix, then read; the tree is walked once."""
    return read_contents(stage(list_tree(spark, root, extensions), "listing"), partitions)
