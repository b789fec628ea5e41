"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents start in shards dealt by a hash. In each round linked documents look
at where their neighbours are and ask to move to the shard that holds most of
them; quotas admit as much as each shard has room for, counting what leaves it,
and the requests that join most neighbours go first. A link is the membership
of a hub (here: an equal text), so members meet by joins with the hub's shards
and pairs are never made. Documents without links have no edge to cut: they are
dealt last and fill what is left, so that every shard gets the same size.

Copies of a text that start in the same cell travel as one node with a count.
A text has at most ``CELLS`` nodes per shard number, so a group with a third of
all rows is hundreds of nodes, none of them a large share of the rows. A group
too large for a shard gets as many home shards as it needs. All rounds work on
nodes; every table is written to the shared folder, and the driver holds
numbers per pair of shards and at most ``LARGE`` large documents, which it deals
from the largest on to the emptiest shard.

A shard's size differs from the mean by less than one hundredth of it, or by
the largest document if that is more. A null text has no bytes and is equal to
the empty one. Very long texts are one document of their size; a table with
fewer documents than shards leaves shards empty. Repeated rows and rows that
share a key or have none are documents of their own. Equal rows are told apart
by their place in the table, so a repeated run over the same files gives the
same shards. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import stage

# Parts of a hub that start in the same shard.
CELLS = 16
# Documents above total / LARGE are dealt one by one; there cannot be more than LARGE of them.
LARGE = 10_000
# Added to the bytes of each text.
OVERHEAD = 16
ROUNDS = 24
_FINE = 1024


def quotas(loads: np.ndarray, asked: np.ndarray, capacity: float) -> np.ndarray:
    """Bytes each shard may receive of ``asked[from, to]`` so that none ends above ``capacity``.

    What a shard gives away makes room in it; requests are cut in proportion
    until all shards hold. Shards that start above the capacity get no more than
    they give.
    """
    flow = asked.astype(float).copy()
    for _ in range(200):
        room = np.maximum(capacity - loads + flow.sum(1), 0.0)
        coming = flow.sum(0)
        share = np.where(coming > room, room / np.maximum(coming, 1e-9), 1.0)
        if (share >= 1 - 1e-9).all():
            break
        flow *= share
    return np.floor(flow.sum(0))


def _thresholds(requests: DataFrame, shard: str, limits: np.ndarray) -> dict[int, int]:
    """Per shard the last rank up to which the bytes of ``requests`` stay within its limit.

    Ranks are few, so the running sum is over cells and not over requests.
    """
    cells = requests.groupBy(shard, "rank").agg(F.sum("bytes").alias("bytes"))
    running = F.sum("bytes").over(Window.partitionBy(shard).orderBy("rank"))
    limit = F.element_at(F.array(*[F.lit(float(v)) for v in limits]), F.col(shard) + 1)
    kept = cells.select(shard, "rank", (running <= limit).alias("fits")).where("fits")
    return {r[0]: r[1] for r in kept.groupBy(shard).agg(F.max("rank")).collect()}


def _ranked(strength: Column, node: Column) -> Column:
    """Small for strong requests; equal strengths go by a hash."""
    return (63 - F.floor(F.log2(F.greatest(strength, F.lit(1))))).cast("int") * _FINE + F.pmod(F.xxhash64(node), F.lit(_FINE)).cast("int")


def _within(column: str, bounds: dict[int, int], shards: int, above: int) -> Column:
    """Whether ``rank`` is at most the bound of the shard in ``column`` (``above`` for shards without one)."""
    values = F.array(*[F.lit(int(bounds.get(s, above))) for s in range(shards)])
    return F.col("rank") <= F.element_at(values, F.col(column) + 1)


def _requests(at: DataFrame, links: DataFrame, shards: int, capacity: float, full: set[int]) -> DataFrame:
    """Where each node wants to go: ``(node, n, bytes, shard, near, to, rank)``; ``to`` is null if it stays.

    ``near`` counts its neighbours in its own shard.
    """
    seated = links.join(at, "node")
    votes = seated.groupBy("hub", "shard").agg(F.sum("n").alias("votes"), F.sum("bytes").alias("bytes"))
    # Shards of a hub, at most all: most members first, then in an order of the hub's own.
    entry = F.struct((-F.col("votes")).alias("order"), F.xxhash64("hub", "shard").alias("tie"), "shard")
    hubs = votes.groupBy("hub").agg(F.sort_array(F.collect_list(entry)).alias("homes"), F.sum("bytes").alias("held"))
    seen = seated.join(hubs, "hub")
    place = F.array_position(F.transform("homes", lambda h: h["shard"]), F.col("shard"))
    needed = F.ceil(F.col("held") / F.lit(max(capacity, 1.0))).cast("int")
    better = F.slice("homes", F.lit(1), (F.col("place") - 1).cast("int"))
    if full:
        better = F.filter(better, lambda h: ~h["shard"].isin(sorted(full)))
    seen = seen.withColumn("place", place).withColumn("needed", needed).withColumn("better", better)
    spread = F.pmod(F.xxhash64("node"), F.least(F.col("needed"), F.size("better"))).cast("int")
    home = F.when((F.col("place") > F.col("needed")) & (F.size("better") > 0), F.get("better", spread))
    own = F.element_at("homes", F.col("place").cast("int"))
    asked = seen.select(
        "node",
        "n",
        "bytes",
        "shard",
        home["shard"].alias("to"),
        F.coalesce(-home["order"], F.lit(0)).alias("there"),
        (-own["order"] - F.col("n")).alias("near"),
    ).repartition(F.col("node"))
    facts = [F.first(c).alias(c) for c in ("n", "bytes", "shard")]
    by_shard = asked.groupBy("node", "to").agg(*facts, F.sum("there").alias("there"), F.sum("near").alias("near"))
    choice = F.max(F.when(F.col("to").isNotNull(), F.struct("there", "to")))
    wanted = by_shard.groupBy("node").agg(*facts, F.sum("near").alias("near"), choice.alias("best"))
    gain = F.col("best")["there"] - F.col("near")
    return wanted.select(
        "node", "n", "bytes", "shard", "near", F.when(gain > 0, F.col("best")["to"]).alias("to"), _ranked(F.coalesce(gain, F.lit(0)), F.col("node")).alias("rank")
    )


def propagate(nodes: DataFrame, links: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """``(node, shard)`` for ``nodes`` ``(node, n, bytes, shard)``; null where a node does not fit.

    ``links`` ``(node, hub)`` tie the nodes of a hub together; a node may have
    several hubs, and one without any stays where it is if there is room.
    Bytes in a shard stay within ``capacity``.
    """
    at = nodes.join(links.select("node").distinct(), "node", "left_semi")
    full: set[int] = set()
    for _ in range(rounds):
        wanted = stage(_requests(at, links, shards, capacity, full), "requests")
        loads, asked = np.zeros(shards), np.zeros((shards, shards))
        for origin, to, held in wanted.groupBy("shard", "to").agg(F.sum("bytes")).collect():
            loads[origin] += held
            if to is not None:
                asked[origin, to] += held
        limits = quotas(loads, asked, capacity)
        bound = {int(s) for s in np.flatnonzero(limits + 1 < asked.sum(0))}
        last = _thresholds(wanted.where(F.col("to").isin(sorted(bound))), "to", limits) if bound else {}
        above = {s: last.get(s, -1) for s in bound}
        moves = F.col("to").isNotNull() & F.coalesce(_within("to", above, shards, 1 << 30), F.lit(False))
        at = wanted.select("node", "n", "bytes", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard"), "near")
        refused = bool(bound - set(last)) and not (asked.sum(0) > 0)[[s for s in range(shards) if s not in bound or s in last]].any()
        if not asked.any() or (refused and bound == full):
            break
        full = bound
    return _released(at, shards, capacity)


def _released(at: DataFrame, shards: int, capacity: float) -> DataFrame:
    """``(node, shard)``, the shard being null for the least linked nodes of shards above the capacity."""
    if "near" not in at.columns:
        at = at.withColumn("near", F.lit(0))
    loads = {r[0]: r[1] for r in at.groupBy("shard").agg(F.sum("bytes")).collect()}
    over = {s: held for s, held in loads.items() if held > capacity}
    if not over:
        return at.select("node", "shard")
    ranked = at.where(F.col("shard").isin(sorted(over))).withColumn("rank", _ranked(F.col("near"), F.col("node")))
    kept = _thresholds(ranked, "shard", np.array([capacity] * shards))
    bounds = {s: kept.get(s, -1) for s in over}
    held = at.withColumn("rank", _ranked(F.col("near"), F.col("node")))
    return held.select("node", F.when(_within("shard", bounds, shards, 1 << 30), F.col("shard")).alias("shard"))


def _deal(sizes: list[tuple[int, int]], loads: list[float]) -> list[tuple[int, int]]:
    """``(row, shard)``: the largest first, each to the emptiest shard; ``loads`` is brought up to date."""
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for size, row in sorted(sizes, reverse=True):
        load, s = heapq.heappop(heap)
        out.append((row, s))
        loads[s] = load + size
        heapq.heappush(heap, (load + size, s))
    return out


def rooms(loads: list[float], rest: float) -> list[float]:
    """How ``rest`` is dealt over shards so that the fullest ones after it are as low as can be."""
    ordered = sorted(loads)
    level, below = ordered[0] if ordered else 0.0, rest
    for i, load in enumerate(ordered):
        after = ordered[i + 1] if i + 1 < len(ordered) else float("inf")
        step = min(below, (after - load) * (i + 1))
        level = load + step / (i + 1)
        below -= step
        if below <= 0:
            break
    return [max(0.0, level - load) for load in loads]


def _fill(spark: SparkSession, rows: DataFrame, loads: list[float], total: int) -> DataFrame:
    """``rows`` ``(…, row, size, bucket, shard)`` with a shard for those that have none."""
    free = F.col("shard").isNull()
    big = F.col("size") * LARGE > total
    dealt = _deal([(r.size, r.row) for r in rows.where(free & big).select(F.col("size"), "row").collect()], loads)
    table = spark.createDataFrame(dealt, "row long, dealt int")
    rest = free & ~big
    buckets = rows.where(rest).groupBy("bucket").agg(F.sum("size").alias("held"))
    offsets = {}
    at = 0
    for r in buckets.orderBy("bucket").collect():
        offsets[r.bucket] = at
        at += r.held
    before = spark.createDataFrame(list(offsets.items()), "bucket int, before long")
    ends = np.cumsum(rooms(loads, float(at)))
    ends[-1] = float("inf")
    joined = rows.join(F.broadcast(table), "row", "left").join(F.broadcast(before), "bucket", "left")
    running = F.sum(F.when(rest & F.col("dealt").isNull(), F.col("size")).otherwise(0)).over(Window.partitionBy("bucket").orderBy("row"))
    middle = F.col("before") + running - F.col("size") / 2
    dealt_to = F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends]), lambda e: e <= middle))
    return joined.withColumn("shard", F.coalesce("shard", "dealt", dealt_to).cast("int"))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, size, text_crc32, shard, slot)`` per row; slots number the rows of a shard without gaps."""
    spark = docs.sparkSession
    data = F.coalesce(F.col(text), F.lit(""))
    table = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(data) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(data.cast("binary")).alias("crc"),
        F.struct(F.xxhash64(data).alias("low"), F.xxhash64(F.lit(1), data).alias("high")).alias("hub"),
        F.monotonically_increasing_id().alias("row"),
    )
    table = stage(table.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(shards * CELLS)).cast("int")), "rows")
    total, count = table.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 1_000_000))

    copies = table.groupBy("hub", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    members = copies.withColumn("members", F.sum("n").over(Window.partitionBy("hub"))).where("members > 1")
    node = F.struct(F.col("hub")["low"].alias("low"), F.col("hub")["high"].alias("high"), "cell")
    linked = stage(members.select(node.alias("node"), "hub", "n", "bytes", (F.col("cell") % shards).alias("shard")), "nodes")
    seats = propagate(linked.drop("hub"), linked.select("node", "hub"), shards, total / shards)
    seats = stage(seats.select(F.struct("node.low", "node.high").alias("hub"), F.col("node.cell").alias("cell"), "shard"), "seats")

    bucket = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(parts)).cast("int")
    rows = stage(table.join(seats, ["hub", "cell"], "left").drop("hub", "cell").withColumn("bucket", bucket), "seated")
    loads = [0.0] * shards
    for s, held in rows.where("shard IS NOT NULL").groupBy("shard").agg(F.sum("size")).collect():
        loads[s] = float(held)
    filled = _fill(spark, rows, loads, total)
    order = Window.partitionBy("bucket", "shard").orderBy(F.col("id").asc_nulls_last(), "row")
    placed = stage(filled.select("id", "size", "crc", "shard", "bucket", F.row_number().over(order).alias("place")), "placed")
    # One row per shard and bucket.
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("held")
    starts = sizes.select("shard", "bucket", before.alias("before"))
    numbered = placed.join(F.broadcast(starts), ["shard", "bucket"])
    return numbered.select(
        F.col("id").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("before") + F.col("place") - 1).cast("bigint").alias("slot"),
    )
