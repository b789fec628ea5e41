"""One JSON document read by many tasks.

A document with a list of items may be one very long line, so it is cut at
commas and at the blocks of its file, which Spark's text source reads in
parallel. Whether a comma parts two items depends on everything before it:
whether a string is open, and how deep the brackets are. Each block is
therefore scanned under both states (a string is open at its start or not), the
blocks' sums are put one after the other, a row per block, and only then each
comma's depth is known. Items are put together by their number. No task holds
more than a block or an item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import strip
from ..staging import stage

_HEAD = r'(?s)^\s*\{?\s*"((?:[^"\\]|\\.)*)"\s*:\s*'
_TAIL = r"(?s)\]\s*\}?\s*$"


@dataclass(frozen=True)
class Document:
    """A document's top: ``[``, ``{`` or another first character; members by key, in order; its pieces.

    A member is ``(first piece, last piece, beginning of its value)``; a list is
    the member "" of itself. ``pieces`` is ``(number, text)``.
    """

    kind: str
    members: dict[str, tuple[int, int, str]]
    pieces: DataFrame

    def items(self, key: str) -> DataFrame | None:
        """``(pos, raw)`` of the list that a key holds; ``None`` if it holds no list."""
        first, last, begins = self.members.get(key, (0, 0, ""))
        if not begins.startswith("["):
            return None
        number, text = F.col("number"), F.col("text")
        head = r"(?s)^\s*\[" if self.kind == "[" else _HEAD + r"\["
        text = F.when(number == first, F.regexp_replace(text, head, "")).otherwise(text)
        # The last piece ends the list, and the object if the list is its last member.
        text = F.when(number == last, F.regexp_replace(text, _TAIL, "")).otherwise(text)
        found = self.pieces.where(number.between(first, last)).select((number - first).alias("pos"), strip(text).alias("raw"))
        # An empty list is one empty piece.
        return found.where((F.col("raw") != "") | F.lit(first != last))

    def scalar(self, key: str) -> str | None:
        """The text of a member that is no list and no object."""
        first, last, begins = self.members.get(key, (0, -1, ""))
        return begins.strip() if first == last and not begins.startswith(("[", "{")) else None


def _outside(value: Column, opened: int) -> Column:
    """What stands outside of strings, if one is open at the start or not."""
    bare = F.regexp_replace(value, r"(?s)\\.", "")
    return F.array_join(F.filter(F.split(bare, '"', -1), lambda part, i: i % 2 == opened), " ")


def _depth(outside: Column) -> Column:
    opening = F.length(outside) - F.length(F.translate(outside, "[{", ""))
    return opening - F.length(outside) + F.length(F.translate(outside, "]}", ""))


def _scanned(spark: SparkSession, path: str) -> DataFrame:
    """Fragments between commas, in order of ``(block, at)``, with the quotes in them and their depths under both states."""
    value = F.col("value")
    quotes = F.size(F.split(F.regexp_replace(value, r"(?s)\\.", ""), '"', -1)) - 1
    read = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    return read.select("*", (quotes % 2).alias("odd"), _depth(_outside(value, 0)).alias("out"), _depth(_outside(value, 1)).alias("in"))


def _placed(fragments: DataFrame) -> DataFrame:
    """Fragments with ``open`` (a string is open after it) and ``depth`` after it."""
    before = W.partitionBy("block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    local = fragments.withColumn("turned", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    as_outside = F.when(F.col("turned") == 0, F.col("out")).otherwise(F.col("in"))
    as_inside = F.when(F.col("turned") == 0, F.col("in")).otherwise(F.col("out"))
    local = local.withColumn("as_outside", as_outside).withColumn("as_inside", as_inside)
    # A row per block: in order, their sums tell the state each one begins in.
    order = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = local.groupBy("block").agg(
        F.sum("odd").alias("odd"), F.sum("as_outside").alias("as_outside"), F.sum("as_inside").alias("as_inside")
    )
    blocks = blocks.withColumn("opened", F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2)
    change = F.when(F.col("opened") == 0, F.col("as_outside")).otherwise(F.col("as_inside"))
    blocks = blocks.withColumn("change", change).withColumn("base", F.coalesce(F.sum("change").over(order), F.lit(0)))
    joined = local.join(blocks.select("block", "opened", "base"), "block")
    upto = W.partitionBy("block").orderBy("at")
    own = F.when(F.col("opened") == 0, F.col("as_outside")).otherwise(F.col("as_inside"))
    return joined.select(
        "block",
        "at",
        "value",
        ((F.col("opened") + F.col("turned") + F.col("odd")) % 2).alias("open"),
        (F.col("base") + F.sum(own).over(upto)).alias("depth"),
    )


def _numbered(placed: DataFrame, levels: list[int], names: list[str]) -> DataFrame:
    """Add running numbers of the pieces that end at a comma of depth up to each level."""
    ends = [((F.col("open") == 0) & (F.col("depth") <= level)).cast("long") for level in levels]
    before = W.partitionBy("block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    order = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = placed.groupBy("block").agg(*[F.sum(end).alias(f"{n}_all") for end, n in zip(ends, names)])
    blocks = blocks.select("block", *[F.coalesce(F.sum(f"{n}_all").over(order), F.lit(0)).alias(f"{n}_base") for n in names])
    joined = placed.join(blocks, "block")
    own = [(F.col(f"{n}_base") + F.coalesce(F.sum(end).over(before), F.lit(0))).alias(n) for end, n in zip(ends, names)]
    return joined.select("block", "at", "value", *own)


def read_document(spark: SparkSession, path: str) -> Document:
    """Cut the JSON document at ``path``; one that does not end as it began is a ``ValueError``."""
    fragments = stage(_scanned(spark, path), "fragments")
    first = fragments.orderBy("block", "at").first()
    kind = first["value"].strip()[:1] if first else ""
    if kind not in ("[", "{"):
        return Document(kind, {}, spark.createDataFrame([], "number long, text string"))
    placed = stage(_placed(fragments), "placed")
    last = placed.orderBy(F.desc("block"), F.desc("at")).first()
    ends = F.col("value").rlike(r"\]\s*$" if kind == "[" else r"\}\s*$")
    # Every comma lies inside the outermost brackets.
    early = placed.where((F.col("open") == 0) & (F.col("depth") < 1)).limit(2).count()
    if last["open"] or last["depth"] != 0 or early != 1 or not placed.orderBy(F.desc("block"), F.desc("at")).limit(1).select(ends).first()[0]:
        raise ValueError(f"{path} is not a complete JSON document")
    levels = [1, 1] if kind == "[" else [1, 2]
    numbered = _numbered(placed, levels, ["member", "number"])
    if kind == "[":
        numbered = numbered.withColumn("member", F.lit(0).cast("long"))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"]), ",")
    pieces = stage(numbered.groupBy("member", "number").agg(text.alias("text")), "pieces")
    spans = pieces.groupBy("member").agg(F.min("number").alias("first"), F.max("number").alias("last"))
    if kind == "[":
        row = spans.first()
        return Document(kind, {"": (row["first"], row["last"], "[")}, pieces.select("number", "text"))
    heads = pieces.join(spans, (pieces["number"] == spans["first"]) & (pieces["member"] == spans["member"])).select(
        "first", "last", F.regexp_extract("text", _HEAD, 1).alias("key"), F.substring(F.regexp_replace("text", _HEAD, ""), 1, 64).alias("begins")
    )
    members: dict[str, tuple[int, int, str]] = {}
    # The keys of the outermost object.
    rows = heads.orderBy("first").collect()
    for row in rows:
        begins = row["begins"]
        if row is rows[-1] and not begins.startswith(("[", "{")):
            begins = begins.rstrip().removesuffix("}")
        members.setdefault(row["key"], (row["first"], row["last"], begins))
    return Document(kind, members, pieces.select("number", "text"))
