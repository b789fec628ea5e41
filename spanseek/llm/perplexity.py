"""Text quality by an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text. Its n-grams are strings of one to four
characters as they stand, whatever their script, so its tables grow with the
trusted text. Tasks add up the n-grams of their own texts, counts of equal
n-grams meet, and the model follows by joins of those tables: raw counts for
the longest n-grams, numbers of different left neighbours for shorter ones,
three discounts per order from the counts of counts, and the mass a context
leaves to shorter contexts.

The logarithm of an interpolated probability is a sum of one number for each
n-gram that ends at a character: a seen one adds what it gains over the shorter
context, and every context adds the mass it leaves. So a text's figure is the
sum over its n-grams of count times weight, where the weight of one of four
characters includes those of its endings, and the documents are joined with the
weights. Shards follow the hash of the last two characters, so that an n-gram
and its endings share one; those of one character are in every shard.

1. tasks count the longest n-grams of up to 1,024 documents at a time and send
   each shard its part: n-grams, numbers of documents and counts, packed;
2. a shard's task reads its weights, then takes the parts one after another
   and answers each with one sum per document;
3. the answers of 1,024 documents meet and are added.

An n-gram is one entry per document however often it occurs, and a shard is
repeated for as many tasks as the documents need, by number of the block, so a
frequent ending does not crowd a task. Weights are whole multiples of 2**-20:
sums do not depend on the order of addition, and equal texts have equal figures.
N-grams are known by 54 bits of their hash. Every answer tells how many n-grams
it covers; a document with others than it has stops the job instead of getting a
wrong figure.

A document is kept unless its perplexity exceeds the ``quantile`` of trusted
documents of its language. One trusted document in five is not learnt from;
those set the quantiles, counted exactly over all of them in steps of 0.001 of
the logarithm. A language without trusted documents takes the threshold of
all. Null and empty texts have no perplexity and are not kept. Without trusted
text all others are kept, with perplexity 1. Very long texts are read whole, in
pieces. Repeated rows are rows of their own, ties with the threshold are kept,
empty tables give empty results, and further columns, also those named like a
new one, do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import broadcast_if_small, partitions_for, stage
from . import rows

ORDER = 4
QUANTILE = 0.99
# One trusted document in so many is not learnt from but sets the thresholds.
HELD_PARTS = 5
# What stands before and after a text (no characters by the Unicode standard).
START, END = "\ufdd0", "\ufdd1"
# Characters of a text taken at a time, characters counted at a time, weights of a shard, bytes of documents per task.
PIECE = 1 << 18
_HELD = 3 << 20
_SHARD_ROWS = 1 << 21
_TASK_BYTES = 1 << 30
# Weights packed at a time.
_DEALT = 1 << 17
# Shards of a small model, if there are tasks for them.
_SHARDS = 16
_STEP = 0.001
_UNIT = 1 << 20
_DOC_BITS = 10
_DOCS = 1 << _DOC_BITS
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """``weights``: ``(gram, weight)``, several rows of a gram to be added; the others are added per character and per text."""

    weights: DataFrame
    per_character: float
    per_text: float


# --- n-grams of texts ---------------------------------------------------------------


def pieces(text: str) -> Iterator[str]:
    """Parts of a text with the ``ORDER - 1`` characters before each; the last part ends the text."""
    whole = START * (ORDER - 1) + text + END
    for at in range(0, len(text) + 1, PIECE):
        yield whole[at : at + PIECE + ORDER - 1]


def points_of(parts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes(points: np.ndarray, ends: np.ndarray, orders: Iterator[int]) -> Iterator[np.ndarray]:
    """For each order the 64-bit hashes of the n-grams that end at ``ends``."""
    total, power = np.zeros(ends.size, np.uint64), np.uint64(1)
    wanted = set(orders)
    for k in range(1, max(wanted) + 1):
        total = total + (points[ends - (k - 1)].astype(np.uint64) + np.uint64(1)) * power
        power = np.uint64(int(power) * int(_BASE) % (1 << 64))
        if k in wanted:
            yield rows.mix(total + np.uint64(k))


def ends_of(parts: list[str]) -> np.ndarray:
    """Places of the characters of joined ``parts`` that are not context only."""
    sizes = np.array([len(p) for p in parts])
    own = sizes - (ORDER - 1)
    before = np.repeat(np.cumsum(sizes) - sizes, own)
    return before + (ORDER - 1) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)


# --- the model ------------------------------------------------------------------------


def count(texts: DataFrame, text: str) -> DataFrame:
    """``(gram, n)``: counts of all n-grams of the longest order."""

    def flush(held: list[str]) -> pa.RecordBatch:
        points, ends = points_of(held), ends_of(held)
        (found,) = hashes(points, ends, [ORDER])
        _, first, n = np.unique(found, return_index=True, return_counts=True)
        windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[ends[first] - (ORDER - 1)]
        joined = windows.tobytes().decode("utf-32-le", "surrogatepass")
        grams = [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]
        return pa.RecordBatch.from_pydict({"gram": pa.array(grams, pa.string()), "n": pa.array(n, pa.int64())})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        waiting = 0
        for batch in batches:
            for value in batch.column(0):
                own = value.as_py()
                for part in pieces(own) if own else ():
                    held.append(part)
                    waiting += len(part)
                    if waiting > _HELD:
                        yield flush(held)
                        held, waiting = [], 0
        if held:
            yield flush(held)

    rows.bound_batches(texts.sparkSession)
    own = texts.select(text).mapInArrow(work, "gram string, n bigint")
    return own.groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> Model:
    """The weights of the n-grams of all orders from the (stored) counts of the longest ones."""
    # An order's table: raw counts at the top, else in how many n-grams one longer it is the end.
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        longer = tables[order + 1].select(F.substring("gram", 2, order).alias("gram"))
        tables[order] = stage(longer.groupBy("gram").agg(F.count("*").alias("n")), "counts")

    lower, weights, base, begin = None, [], 0.0, 0.0
    for order in range(1, ORDER + 1):
        table = tables[order]
        kinds = table.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first()
        d = discounts(*kinds)
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        parts = table.select("gram", "n", cut.alias("cut"), F.substring("gram", 1, order - 1).alias("context"))
        sums = F.sum("n").alias("total"), F.sum("cut").alias("freed")
        if lower is None:
            total, freed, symbols = parts.agg(*sums, F.count("*")).first()
            # One more symbol stands for those not seen.
            base = freed / total / (symbols + 1)
            p = (F.col("n") - F.col("cut")) / total + base
            made = parts.select("gram", p.alias("p"), F.log(p / base).alias("weight"))
            lower = stage(made, "probabilities")
        else:
            contexts = stage(parts.groupBy("context").agg(*sums), "contexts")
            contexts = contexts.select("context", "total", (F.col("freed") / F.col("total")).alias("rest"))
            below = lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below"))
            joined = parts.withColumn("shorter", F.substring("gram", 2, order - 1)).join(contexts, "context").join(below, "shorter")
            p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("rest") * F.col("below")
            made = joined.select("gram", p.alias("p"), F.log(p / (F.col("rest") * F.col("below"))).alias("weight"))
            lower = stage(made, "probabilities")
            left = contexts.select(F.col("context").alias("gram"), F.log("rest").alias("weight"))
            weights.append(left)
            begin += left.where(F.col("gram") == START * (order - 1)).agg(F.sum("weight")).first()[0]
        weights.append(lower.select("gram", "weight"))
    seen = weights[0]
    for more in weights[1:]:
        seen = seen.unionByName(more)
    return Model(seen, math.log(base), begin)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams seen once to four times; fixed ones where these are missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(min(max(x, 0.0), k)) if 0 < x else 0.5 for k, x in zip((1, 2, 3), found))


def train(docs: DataFrame, text: str = "text") -> Model | None:
    """The model of all texts of ``docs``; ``None`` if they are empty."""
    counts = stage(count(docs, text), "ngrams")
    return kneser_ney(counts) if counts.limit(1).count() else None


# --- documents joined with the weights ------------------------------------------------


def _planes(values: np.ndarray, dtype: str) -> bytes:
    """The numbers' first bytes, then their second bytes and so on: high bytes are mostly zero and pack well."""
    made = np.ascontiguousarray(values.astype(dtype))
    return made.view(np.uint8).reshape(-1, made.itemsize).T.tobytes()


def _numbers(data: memoryview, n: int, dtype: str) -> tuple[np.ndarray, memoryview]:
    size = n * np.dtype(dtype).itemsize
    planes = np.frombuffer(data[:size], np.uint8).reshape(-1, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype), data[size:]


def pack(columns: list[tuple[np.ndarray, str]]) -> bytes:
    """Columns of numbers as compressed bytes; ``unpack`` with the same types gives them back."""
    sizes = np.array([len(values) for values, _ in columns], "<u4").tobytes()
    raw = sizes + b"".join(_planes(values, dtype) for values, dtype in columns)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, dtypes: list[str]) -> list[np.ndarray]:
    raw = memoryview(pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True))
    sizes, raw = np.frombuffer(raw[: 4 * len(dtypes)], "<u4"), raw[4 * len(dtypes) :]
    out = []
    for n, dtype in zip(sizes.tolist(), dtypes):
        values, raw = _numbers(raw, n, dtype)
        out.append(values)
    return out


# A part: characters of the n-grams, one place after the other, entries per n-gram, document numbers (first one, then
# differences), counts. An answer: documents, sums, n-grams covered. Weights: hashes, whole weights.
_PART = ["<u4", "<u2", "<u2", "<u4"]
_ANSWER = ["<u2", "<i8", "<u4"]
_WEIGHTS = ["<u8", "<i8"]


def parts_of(held: list[str], numbers: list[int], bits: int) -> Iterator[tuple[int, bytes]]:
    """``(shard, part)`` of the joined pieces ``held`` of the documents ``numbers``."""
    points, ends = points_of(held), ends_of(held)
    owner = np.repeat(np.array(numbers, np.uint64), [len(p) - (ORDER - 1) for p in held])
    (whole,) = hashes(points, ends, [ORDER])
    keys, first, counts = np.unique(whole >> np.uint64(_DOC_BITS) << np.uint64(_DOC_BITS) | owner, return_index=True, return_counts=True)
    grams = keys >> np.uint64(_DOC_BITS)
    begin = np.flatnonzero(np.diff(grams, prepend=grams[0] ^ np.uint64(1)))
    entries = np.diff(begin, append=keys.size)
    docs = (keys & np.uint64(_DOCS - 1)).astype(np.int64)
    steps = np.diff(docs, prepend=0)
    steps[begin] = docs[begin]
    at = ends[first[begin]]
    (ending,) = hashes(points, at, [2])
    shard = (ending >> np.uint64(64 - bits)).astype(np.int64)
    of_entry = np.repeat(shard, entries)
    for one in np.unique(shard).tolist():
        own, mine = shard == one, of_entry == one
        letters = np.concatenate([points[at[own] - (ORDER - 1) + i] for i in range(ORDER)])
        yield one, pack([(letters, _PART[0]), (entries[own], _PART[1]), (steps[mine], _PART[2]), (counts[mine], _PART[3])])


def spread(block: int) -> int:
    """Evenly dealt numbers for blocks; their own last bits are alike in all partitions."""
    return (block * int(_BASE) & ((1 << 64) - 1)) >> 33


def answer(data: bytes, grams: np.ndarray, weights: np.ndarray) -> bytes:
    """Per document of a part the sum of count times weight, and how many n-grams were counted."""
    letters, entries, steps, counts = unpack(data, _PART)
    n = entries.size
    points = np.ascontiguousarray(letters.reshape(ORDER, n).T).reshape(-1)
    own = np.zeros(n)
    for found in hashes(points, np.arange(n) * ORDER + ORDER - 1, range(1, ORDER + 1)) if grams.size else ():
        known = found >> np.uint64(_DOC_BITS)
        at = np.minimum(np.searchsorted(grams, known), grams.size - 1)
        own += np.where(grams[at] == known, weights[at], 0.0)
    # Steps begin anew with each n-gram.
    run = np.cumsum(steps, dtype=np.int64)
    begin = np.cumsum(entries, dtype=np.int64) - entries
    docs = run - np.repeat(run[begin] - steps[begin], entries)
    # Whole numbers, far below 2 ** 53: exact in any order.
    sums = np.bincount(docs, np.repeat(own, entries) * counts, _DOCS)
    covered = np.bincount(docs, counts, _DOCS)
    some = np.flatnonzero(covered)
    return pack([(some, _ANSWER[0]), (sums[some], _ANSWER[1]), (covered[some], _ANSWER[2])])


def perplexity(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with ``perplexity`` per character; null for texts without any.

    Rows must come in the same order when a lost task runs again, as they do
    from stored tables; otherwise the job may stop (see above).
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "perplexity"]
    if model is None:
        return docs.select(*kept, F.when(F.length(text) > 0, 1.0).alias("perplexity"))
    tasks = partitions_for(docs, _TASK_BYTES)
    bits = max(1, math.ceil(math.log2(max(min(tasks, _SHARDS), model.weights.count() / _SHARD_ROWS))))
    shards = 1 << bits
    repeats = -(-tasks // shards)
    weights = stage(_sharded(model.weights, bits), "weights")

    # Kept columns travel under names of their own.
    own = [f"__c{i}" for i in range(len(kept))]
    source = docs.select(*[F.col(c).alias(o) for c, o in zip(kept, own)], F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text"))
    fields = source.schema.fields[: len(own)]
    extra = "__row bigint, __slot int, __kind int, __chars bigint, __part binary"
    packed_schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + T.StructType.fromDDL(extra).fields)
    n_own = len(own)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = packed_schema.names

        def flush(types: list[pa.DataType], block: int, held: list[str], numbers: list[int]) -> pa.RecordBatch:
            some, blobs = zip(*parts_of(held, numbers, bits))
            n = len(some)
            slots = pa.array([s * repeats + spread(block) % repeats for s in some], pa.int32())
            columns = [pa.nulls(n, t) for t in types]
            columns += [pa.array([block << _DOC_BITS] * n, pa.int64()), slots, pa.array([1] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(blobs, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        held: list[str] = []
        numbers: list[int] = []
        waiting, block, types = 0, -1, []
        for batch in batches:
            types = [c.type for c in batch.columns[:n_own]]
            row = batch.column(n_own).to_pylist()
            chars = []
            for at, value in zip(row, batch.column(n_own + 1)):
                if at >> _DOC_BITS != block or waiting > _HELD:
                    if held:
                        yield flush(types, block, held, numbers)
                    held, numbers, waiting, block = [], [], 0, at >> _DOC_BITS
                text_here = value.as_py()
                chars.append(len(text_here) if text_here else 0)
                for piece in pieces(text_here) if text_here else ():
                    if waiting > _HELD:
                        yield flush(types, block, held, numbers)
                        held, numbers, waiting = [], [], 0
                    held.append(piece)
                    numbers.append(at & (_DOCS - 1))
                    waiting += len(piece)
            n = batch.num_rows
            slots = pa.array([spread(at >> _DOC_BITS) % (shards * repeats) for at in row], pa.int32())
            columns = [*batch.columns[: n_own + 1], slots, pa.array([1] * n, pa.int32()), pa.array(chars, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if held:
            yield flush(types, block, held, numbers)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, loaded = -1, None
        table: list[list[np.ndarray]] = []
        for batch in batches:
            at = batch.schema.names.index("__slot")
            slots, kinds, blobs = batch.column(at).to_numpy(), batch.column(at + 1).to_numpy(), batch.column(at + 3)
            made: list = [None] * batch.num_rows
            for i, (here, kind) in enumerate(zip(slots.tolist(), kinds.tolist())):
                if here != slot:
                    slot, loaded, table = here, None, []
                blob = blobs[i].as_py()
                if kind == 0:
                    table.append(unpack(blob, _WEIGHTS))
                    continue
                if loaded is None:
                    loaded, table = _added(table), []
                made[i] = None if blob is None else answer(blob, *loaded)
            columns = [*batch.columns[: at + 3], pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(kinds == 1))

    def gathered(group: pa.Table) -> pa.Table:
        sums, covered = np.zeros(_DOCS), np.zeros(_DOCS)
        for blob in group.column("__part").drop_null():
            docs_here, total, n = unpack(blob.as_py(), _ANSWER)
            sums[docs_here] += total
            covered[docs_here] += n
        here = group.filter(pc.is_valid(group.column("__chars")))
        number = here.column("__row").to_numpy() & (_DOCS - 1)
        chars = here.column("__chars").to_numpy()
        if not np.array_equal(covered[number], np.where(chars > 0, chars + 1, 0)):
            raise RuntimeError("rows came in another order when a task ran again: store them first")
        figure = -(sums[number] / _UNIT + per_text) / (chars + 1) - per_character
        found = pa.array(np.exp(figure), pa.float64(), mask=chars == 0)
        return pa.Table.from_arrays([*here.columns[:n_own], found], names=[*own, "perplexity"])

    per_text, per_character = model.per_text, model.per_character
    rows.bound_batches(spark)
    made = source.mapInArrow(parts, packed_schema)
    slot = F.explode(F.sequence(F.col("shard") * repeats, F.col("shard") * repeats + (repeats - 1)))
    given = {"__slot": slot, "__kind": F.lit(0), "__part": F.col("part")}
    dealt = weights.select(*[given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in packed_schema.fields])
    both = made.unionByName(dealt)
    met = both.repartitionById(shards * repeats, F.col("__slot")).sortWithinPartitions("__slot", "__kind")
    answered = met.mapInArrow(answers, packed_schema)
    result = T.StructType([*packed_schema.fields[:n_own], T.StructField("perplexity", T.DoubleType())])
    block = F.shiftright("__row", _DOC_BITS).alias("__block")
    figures = answered.groupBy(block).applyInArrow(gathered, result)
    return figures.select(*[F.col(o).alias(c) for c, o in zip(kept, own)], "perplexity")


def _sharded(weights: DataFrame, bits: int) -> DataFrame:
    """``(shard, part)``: hashes (54 bits) for strings, with weights as whole numbers of ``2 ** -20``."""

    def deal(grams: list[str], weight: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(g) for g in grams])
        points, ends = points_of(grams), np.cumsum(sizes) - 1
        out, ending = np.zeros(len(grams), np.uint64), np.zeros(len(grams), np.uint64)
        for k in range(1, ORDER + 1):
            some = sizes == k
            if some.any():
                (out[some],) = hashes(points, ends[some], [k])
        some = sizes > 1
        if some.any():
            (ending[some],) = hashes(points, ends[some], [2])
        whole = np.rint(weight * _UNIT)
        shard = (ending >> np.uint64(64 - bits)).astype(np.int64)
        for one in range(1 << bits):
            own = (shard == one) & some | (sizes == 1)
            if own.any():
                part = pack([(out[own] >> np.uint64(_DOC_BITS), _WEIGHTS[0]), (whole[own], _WEIGHTS[1])])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([one], pa.int32()), "part": pa.array([part], pa.binary())})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[str] = []
        weight: list[np.ndarray] = []
        for batch in batches:
            grams += batch.column(0).to_pylist()
            weight.append(batch.column(1).to_numpy())
            if len(grams) >= _DEALT:
                yield from deal(grams, np.concatenate(weight))
                grams, weight = [], []
        if grams:
            yield from deal(grams, np.concatenate(weight))

    return weights.select("gram", "weight").mapInArrow(work, "shard int, part binary")


def _added(table: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A shard's hashes in order, with the sums of their weights."""
    if not table:
        return np.zeros(0, np.uint64), np.zeros(0)
    grams, at = np.unique(np.concatenate([g for g, _ in table]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([w for _, w in table]))


# --- thresholds ------------------------------------------------------------------------


def thresholds(trusted: DataFrame, lang: str, quantile: float = QUANTILE) -> DataFrame:
    """``(lang, threshold)``, one row per language and one with null for all, from ``perplexity`` of trusted rows.

    The smallest step that at least ``quantile`` of the rows do not exceed. Rows
    meet as counts per step, so a common language is no large group.
    """
    step = F.ceil(F.log("perplexity") / _STEP).alias("step")
    counted = trusted.where(F.col("perplexity").isNotNull()).groupBy(F.col(lang).alias("lang"), step).count()
    both = counted.where(F.col("lang").isNotNull()).unionByName(counted.groupBy("step").agg(F.sum("count").alias("count")).withColumn("lang", F.lit(None).cast("string")))
    order = Window.partitionBy("lang").orderBy("step")
    run = both.withColumn("below", F.sum("count").over(order)).withColumn("all", F.sum("count").over(Window.partitionBy("lang")))
    found = run.where(F.col("below") >= F.col("all") * quantile).groupBy("lang").agg(F.min("step").alias("step"))
    return found.select("lang", F.exp(F.col("step") * _STEP).alias("threshold"))


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """``(key, lang, perplexity, threshold, keep)`` per row; the keys in ``trusted`` name the rows to learn from.

    Keys are broadcast to the texts only if they are few enough, by count;
    beyond that the join shuffles.
    """
    apart = F.pmod(F.xxhash64(key), F.lit(HELD_PARTS)) == 0
    keys = stage(trusted.select(key).distinct().withColumn("apart", apart), "trusted")
    learnt = broadcast_if_small(keys.where("NOT apart").select(key))
    model = train(docs.join(learnt, key, "left_semi").select(text), text)
    named = docs.select(F.col(key), F.col(lang).cast("string").alias("lang"), F.col(text).alias("__text"))
    measured = stage(perplexity(named, model, "__text", [key, "lang"]), "perplexity")
    unseen = measured.join(keys.where("apart"), key, "left_semi")
    limits = stage(thresholds(unseen, "lang", quantile), "thresholds")
    common = limits.where("lang IS NULL").agg(F.max("threshold")).first()[0]
    own = limits.where("lang IS NOT NULL").withColumnRenamed("threshold", "own")
    limit = F.coalesce("own", F.lit(float("inf") if common is None else common))
    keep = F.coalesce(F.col("perplexity") <= limit, F.lit(False))
    joined = measured.join(own, "lang", "left")
    return joined.select(key, "lang", "perplexity", limit.alias("threshold"), keep.alias("keep"))
