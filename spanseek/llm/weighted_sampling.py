"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a weighted set: its words (runs of characters other than ASCII white
space) with their counts. For each sample and term, two gamma(2, 1) variables
and a uniform one are drawn from hashes of the term. With S the weight:
``t = floor(ln S / r + b)``, ``ln a = ln c - r (t - b + 1)``; the sample is the
term of the smallest ``a`` and its ``t``. Two texts agree on a sample with a
probability equal to the generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones. As ``ln a`` depends on term and ``t``
alone, its value stands for the sample, so one minimum per sample is all a text
has to aggregate.

Null texts count as empty. Empty texts have one common term of weight one, so
they are alike among themselves and unlike all others. Very long texts are read
whole, repeated rows are rows of their own, an empty table gives an empty
result, and further columns, whatever their names, do not matter.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import partitions_for, stage

SAMPLES = 30
# Cells of the key range that hold equally many rows, and bytes of text per bucket.
CELLS = 256
BUCKET_BYTES = 8 << 20
# Buckets per cell of small tables, so that tasks get similar numbers of them.
LEAST_PARTS = 4
_WHITE = r"[\x20\x09-\x0D]+"


def weights(text: Column) -> Column:
    """Sorted 64-bit numbers of the words of a text, repeats included."""
    words = F.split(F.trim(F.regexp_replace(text, _WHITE, " ")), " ")
    return F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))


def counted(rows: DataFrame, terms: str, keys: list[str]) -> DataFrame:
    """``keys, term, weight``: the runs of equal numbers in the sorted array ``terms``."""
    n = F.size(terms)
    last = F.filter(
        F.sequence(F.lit(1), n), lambda i: (i == n) | (F.element_at(terms, i) != F.element_at(terms, F.least(i + 1, n)))
    )
    ends = rows.select(*keys, terms, last.alias("ends"))
    starts = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    runs = F.zip_with("ends", starts, lambda e, s: F.struct(F.element_at(terms, e).alias("term"), (e - s).alias("weight")))
    return ends.select(*keys, F.inline(runs))


def _uniform(bits: Column) -> Column:
    """From a signed 32-bit number to the open unit interval."""
    return (bits.cast("double") + F.lit(2147483648.5)) * F.lit(2.0**-32)


def _low(x: Column) -> Column:
    return F.shiftright(F.shiftleft(x, 32), 32)


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """``ln a`` of one term for sample ``k``."""
    x, y = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.log(_uniform(_low(x)) * _uniform(F.shiftright(x, 32)))
    c = -F.log(_uniform(_low(y)) * _uniform(F.shiftright(y, 32)))
    b = _uniform(F.hash(x, y))
    t = F.floor(log_weight / r + b).cast("double")
    return F.log(c) - r * (t - b + F.lit(1.0))


def fingerprints(rows: DataFrame, terms: str, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, samples``: an array of 32-bit samples for each row of the sorted numbers ``terms``.

    ``keys`` must tell the rows apart. There is no exchange if the rows are
    already partitioned by some of them.
    """
    drawn = counted(rows, terms, keys).withColumn("weight", F.log(F.col("weight").cast("double")))
    names = [f"a{k}" for k in range(samples)]
    least = [F.min(sample(F.col("term"), F.col("weight"), k)).alias(name) for k, name in enumerate(names)]
    return drawn.groupBy(*keys).agg(*least).select(*keys, F.array(*[F.hash(a) for a in names]).alias("samples"))


def likeness(a: str, b: str) -> Column:
    """The share of samples on which two fingerprints agree."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda agree: agree)
    return F.size(same).cast("double") / F.size(a)


def hexadecimal(samples: str) -> Column:
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint").bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def _bucketed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(bucket, id, order, text)`` with buckets that follow the order of the key.

    Quantiles of the key bound cells with equally many rows; cells are cut
    evenly so that buckets stay small on large tables. A key that is a bound, as
    every one with 1/CELLS of the rows is, has buckets of its own, as has null;
    there the hash of the text, ``order``, cuts them. Only the bounds, a fixed
    number, come to the driver.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(key).alias("id"), given.alias("text"), F.xxhash64(given).alias("order"))
    parts = max(LEAST_PARTS, -(-partitions_for(docs.select(text), BUCKET_BYTES) // CELLS))
    quantiles = F.percentile_approx("id", [i / CELLS for i in range(CELLS + 1)], F.lit(10 * CELLS))
    found, without, rows = source.agg(quantiles, F.count_if(F.col("id").isNull()), F.count("*")).first()
    share = _uniform(F.shiftright("order", 32))
    null_cells = max(1, -(-without * CELLS * parts // max(1, rows)))
    bucket = F.lit(None).cast("bigint")
    if found:
        bounds = F.array(*[F.lit(b) for b in found])
        cell = F.size(F.filter(bounds, lambda b: b <= F.col("id"))).cast("bigint")
        own = {b: n * parts for b, n in Counter(found).items() if n > 1 or parts > LEAST_PARTS}
        room = max(own.values(), default=0)
        low, high = F.try_element_at(bounds, F.greatest(cell, F.lit(1)).cast("int")), F.try_element_at(bounds, (cell + 1).cast("int"))
        along = F.coalesce((F.col("id") - low) / F.nullif(high - low, F.lit(0)), F.lit(0.0))
        within = room + F.least(F.floor(along * parts), F.lit(parts - 1))
        if own:
            cuts = F.try_element_at(F.create_map(*[F.lit(x) for pair in own.items() for x in pair]), F.col("id"))
            within = F.when(cuts.isNotNull(), F.floor(share * cuts)).otherwise(within)
        bucket = cell * (room + parts) + within
    bucket = F.when(F.col("id").isNull(), F.floor(share * null_cells) - null_cells).otherwise(bucket.cast("bigint"))
    return source.select(bucket.alias("bucket"), "id", "order", "text")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(bucket, place, id, text, edited)`` per row, partitioned by ``bucket``.

    The last third of a text (code points, rounded down) is replaced by as many
    of the first ones of the next text, by descending key; after the last comes
    the first. Equal keys go by the hash of the text, then by text; null keys come last.
    """
    rows = _bucketed(docs, key, text)
    order = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), F.col("order").desc(), "text")
    placed = rows.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next"))
    # The last row of a bucket goes on with the first of the next bucket that has rows: one row per bucket.
    firsts = placed.where("place = 1").select("bucket", F.col("text").alias("first"))
    down = Window.orderBy(F.col("bucket").desc())
    numbers = rows.select("bucket").distinct()
    following = numbers.select("bucket", F.lead("bucket").over(down).alias("after"), F.max("bucket").over(Window.partitionBy()).alias("top"))
    following = following.select(F.col("bucket").alias("from"), F.coalesce("after", "top").alias("bucket"))
    heads = firsts.join(following, "bucket").select(F.col("from").alias("bucket"), "first")
    joined = placed.join(heads, "bucket").withColumn("next", F.coalesce("next", "first"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    changed = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) AS int))"), F.substring(F.col("next"), F.lit(1), third))
    return joined.select("bucket", "place", "id", "text", changed.alias("edited"))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Per row: key, ``n_chars``, ``edited`` hash, both fingerprints and the likeness to the edited and the next text.

    One exchange of the texts, by bucket; everything up to the fingerprints
    keeps its partitioning.
    """
    rows = edited(docs, key, text)
    texts = [F.struct(F.lit(i).alias("which"), weights(F.col(c)).alias("terms")) for i, c in enumerate(("text", "edited"))]
    both = F.inline(F.array(*texts))
    prints = fingerprints(rows.select("bucket", "place", both), "terms", ["bucket", "place", "which"], samples)
    paired = prints.groupBy("bucket", "place").agg(
        F.max(F.when(F.col("which") == 0, F.col("samples"))).alias("own"),
        F.max(F.when(F.col("which") == 1, F.col("samples"))).alias("changed"),
    )
    facts = rows.select("bucket", "place", "id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    stored = stage(facts.join(paired, ["bucket", "place"]), "fingerprints")

    order = Window.partitionBy("bucket").orderBy("place")
    after = stored.withColumn("next", F.lead("own").over(order))
    numbers = stored.where("place = 1").select("bucket", "own")
    down = Window.orderBy(F.col("bucket").desc())
    ordered = numbers.select("bucket", F.lead("own").over(down).alias("after"), F.first("own").over(down).alias("top"))
    heads = ordered.select("bucket", F.coalesce("after", "top").alias("head"))
    final = after.join(heads, "bucket").withColumn("next", F.coalesce("next", "head"))
    return final.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_sha256",
        hexadecimal("own").alias("fingerprint"),
        hexadecimal("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )
