"""File catalogue: which kinds of files a tree holds.

Input is any DataFrame with ``path`` (and ``rel_path``, relative to the root,
where hidden files matter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ALLOWED_EXTENSIONS, NO_EXTENSION, NO_EXTENSION_NAMES
from ..functions import path_suffix, two_decimals


def _kind(path: Column) -> Column:
    """Lower-cased suffix, or the name for files without one."""
    suffix = F.lower(path_suffix(path))
    return F.when(suffix == "", NO_EXTENSION).otherwise(suffix)


def drop_hidden(files: DataFrame) -> DataFrame:
    """Drop files with a path part that starts with a dot.

    The path below the root is tested, so the root's own name hides nothing.
    """
    hidden = F.exists(F.split("rel_path", "/"), lambda part: part.startswith("."))
    return files.where(~hidden)


def extension_counts(files: DataFrame) -> DataFrame:
    """Files per kind."""
    return files.groupBy(_kind(F.col("path")).alias("ext")).agg(F.count("*").alias("n_files"))


def extension_report(files: DataFrame) -> DataFrame:
    """Count and share of every kind, sorted for reading, with a total row.

    Most frequent first, equal counts by name, files without suffix next to
    last, the total last. The order is a range sort over one row per kind. An
    empty catalogue gives no rows.
    """
    counts = extension_counts(files)
    total = counts.agg(F.sum("n_files").alias("n_files")).where(F.col("n_files") > 0)
    ranked = counts.select("ext", "n_files", (F.col("ext") == NO_EXTENSION).cast("int").alias("place"))
    rows = ranked.unionByName(total.select(F.lit("total").alias("ext"), "n_files", F.lit(2).alias("place")))
    share = 100.0 * F.col("n_files") / total.scalar()
    ordered = rows.orderBy("place", F.desc("n_files"), "ext")
    return ordered.select("ext", "n_files", two_decimals(share).alias("percentage"))


def extension_list(files: DataFrame) -> DataFrame:
    """Distinct suffixes in lower case, sorted, with "" last."""
    suffixes = files.select(F.lower(path_suffix(F.col("path"))).alias("ext")).distinct()
    return suffixes.orderBy(F.col("ext") == "", "ext")


def find_by_extension(files: DataFrame, extension: str, include_hidden: bool = False) -> DataFrame:
    """Files of one kind, sorted by path parts.

    Case does not matter, a missing leading dot is added, and ``no_ext``,
    ``no-ext`` or ``noext`` ask for files without suffix.
    """
    wanted = extension.lower()
    if wanted in NO_EXTENSION_NAMES:
        wanted = NO_EXTENSION
    elif not wanted.startswith("."):
        wanted = "." + wanted
    seen = files if include_hidden else drop_hidden(files)
    return seen.where(_kind(F.col("path")) == wanted).orderBy(F.split("path", "/"))


def tree_status(files: DataFrame, extensions: list[str]) -> DataFrame:
    """One row ``(n_files, newest_mtime)`` for the listed suffixes; zeros if none."""
    return files.where(path_suffix(F.col("path")).isin(list(extensions))).agg(
        F.count("*").alias("n_files"), F.coalesce(F.max("mtime"), F.lit(0.0)).alias("newest_mtime")
    )


def unknown_extensions(requested: DataFrame, allowed: DataFrame) -> DataFrame:
    """Requested suffixes that are not allowed: an anti join on ``ext``."""
    return requested.select("ext").distinct().join(allowed, "ext", "left_anti")


def check_extensions(extensions: list[str], allowed: list[str] = ALLOWED_EXTENSIONS) -> list[str]:
    """Validate a caller's list before any job starts."""
    if not extensions:
        raise ValueError("at least one extension is needed")
    unknown = sorted(set(extensions) - set(allowed))
    if unknown:
        raise ValueError(f"extensions not allowed: {unknown}")
    return list(extensions)
