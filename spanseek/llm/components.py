"""Connected components by alternating large and small stars.

Every round rewires the links of a node to the smallest node it knows, first
for larger neighbours, then for smaller ones, until all nodes hang on the
smallest of their component. Each round's links are written to the shared
folder; the driver sees two numbers per round. Nodes of large degree are
summed before they are shuffled, and their joins can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return row[0], row[1]


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` ``(a, b)`` of numbers, ``root`` being the smallest in reach.

    Links of a node with itself, repeated links and nulls have no effect; nodes
    without a link to another node are not returned.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stage(pairs, "links")
    before, now = None, _signature(pairs)
    while now != before:
        both = pairs.union(pairs.select("v", "u"))
        nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, _signature(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
