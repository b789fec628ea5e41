"""BM25 over chunks, as tables.

An index is four Parquet tables:

``postings``      term, span, tf, dl, block. Bucketed by span, sorted by term
                  and block. The term "" marks a chunk once, so that chunks
                  without tokens count and document statistics need no second
                  table.
``term_stats``    term, df, idf; files sorted by term.
``corpus_stats``  one row: n_docs, total_length, avgdl.
``limits``        term, block, top_tf, least_dl; files sorted by term.

Bucketing by span means every posting of a chunk sits in one bucket: scores
are summed without a shuffle, whatever the frequency of a term, and only the
best k rows per query and bucket cross the network. Sorting by term lets a
single question read just the pages that hold its terms.

A bucket's chunks are dealt into blocks by file. ``limits`` bounds the weight a
term can have in a block, so a top-k search can score a query's most promising
blocks first and skip those that cannot reach its k-th score.

Weights are not stored: ``idf`` belongs to the term, ``tf`` and ``dl`` to the
posting, so a weight is one product at query time and adding it to the table
would cost a shuffle of all postings by term.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BM25_B, BM25_K1, STOP_WORDS
from ..functions import corpus_tokens, query_terms
from ..schemas import SPAN, SPAN_KEY
from ..staging import is_small, new_folder, partitions_for, stage

CHUNK_MARK = ""
_POSTING_COLUMNS = (
    "term string, file_path string, first_character_index int, "
    "last_character_index int, tf bigint, dl int, block bigint"
)
_COUNT_FIELDS = [
    T.StructField("dl", T.IntegerType()),
    T.StructField("term", T.StringType()),
    T.StructField("tf", T.LongType()),
    T.StructField("block", T.LongType()),
]
_COUNTED = [*SPAN, *(f.name for f in _COUNT_FIELDS)]
# Chunks that are counted at a time.
_SLICE_ROWS = 1000
# Text per bucket; a bucket is one task in building and in searching.
_BUCKET_BYTES = 512 << 20
# Text per block, the unit that a pruned search skips.
_BLOCK_BYTES = 128 << 10
# Blocks of a query that are scored before others are skipped.
PROBES = 8
# Postings of all queries' terms from which a search is pruned; below, the bounds cost more than they save.
PRUNED_FROM = 20_000_000
# Blocks that are named in a filter of the scan.
_MAX_NAMED_BLOCKS = 1000
# Files a task may have open; with more buckets than that in a task, Spark sorts the rest by bucket.
_WRITERS, _WRITERS_OPEN = "spark.sql.maxConcurrentOutputFileWriters", 4
# Query terms, and bytes of them, that are broadcast at a time.
MAX_BLOCK_ROWS = 1_000_000
_BLOCK_TERM_BYTES = 64 << 20
# Terms above this share of all postings are joined apart from the rest.
_HOT_SHARE = 10_000


@dataclass(frozen=True)
class LexicalIndex:
    """Tables of an index and the two constants of its weights."""

    postings: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    limits: DataFrame
    k1: float = BM25_K1
    b: float = BM25_B


def tokenize(chunks: DataFrame, column: str = "content") -> DataFrame:
    """One row per token of a chunk, in order, stop words included."""
    tokens = corpus_tokens(F.col(column), drop_stop_words=False)
    return chunks.select(*SPAN, F.posexplode(tokens).alias("position", "term"))


def drop_stopwords(tokens: DataFrame) -> DataFrame:
    """Remove the English stop words."""
    return tokens.where(~F.col("term").isin(STOP_WORDS))


def count_terms(chunks: DataFrame, partitions: int, blocks: int = 1) -> DataFrame:
    """Postings of ``chunks`` with one shuffle, of the chunks themselves.

    Each of the ``partitions`` has ``blocks`` blocks of its own; the chunks of a
    file that meet in a partition are in one block.

    Text is more compact than its tokens, and tokens are made and counted after
    the shuffle. Rows of one span and length come one after the other, so they
    are counted together, however many they are, and nothing is held but one
    slice of rows and one span's counts.
    """
    spread = chunks.select(*SPAN, "content").repartition(partitions, *SPAN_KEY)
    tokens = spread.select(*SPAN, corpus_tokens(F.col("content")).alias("tokens"))
    marked = F.concat(F.array(F.lit(CHUNK_MARK)), F.col("tokens")).alias("terms")
    bucket = F.pmod(F.hash(*SPAN_KEY), F.lit(partitions)).cast("bigint")
    block = bucket * blocks + F.pmod(F.xxhash64("file_path"), F.lit(blocks))
    listed = tokens.select(*SPAN, F.size("tokens").alias("dl"), block.alias("block"), marked)
    counted = T.StructType([*(chunks.schema[c] for c in SPAN), *_COUNT_FIELDS])
    return listed.sortWithinPartitions(*SPAN, "dl").mapInArrow(_count_slices, counted)


def _count_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of each span and length; those of the last one wait for the next slice."""
    held = None
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE_ROWS):
            found, owner = _count_slice(batch.slice(at, _SLICE_ROWS))
            if not found.num_rows:
                continue
            last = owner.max()
            first = found.filter(pa.array(owner == 0))
            if held is not None and _owner(held) == _owner(first):
                first = _merged(held, first)
            elif held is not None:
                yield from held.to_batches()
            if last > 0:
                yield from first.combine_chunks().to_batches()
                yield from found.filter(pa.array((owner > 0) & (owner < last))).to_batches()
                held = found.filter(pa.array(owner == last))
            else:
                held = first
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _count_slice(rows: pa.RecordBatch) -> tuple[pa.Table, np.ndarray]:
    """Counts in sorted rows, by term and block (so that sorting all of them merges few runs), and each one's span by number."""
    sizes = pc.fill_null(pc.list_value_length(rows.column("terms")), 0).to_numpy(zero_copy_only=False)
    rows, sizes = rows.filter(pa.array(sizes > 0)), sizes[sizes > 0]
    new = np.zeros(len(sizes), bool)
    for name in (*SPAN, "dl"):
        codes = rows.column(name).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    starts, owner = np.flatnonzero(np.append(True, new[1:])), np.cumsum(new)
    coded = rows.column("terms").flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    blocks, block = np.unique(rows.column("block").to_numpy(zero_copy_only=False), return_inverse=True)
    # Term, block and span in one number.
    spans, held = max(1, len(starts)), max(1, len(blocks))
    pairs = (place[coded.indices.to_numpy()] * held + np.repeat(block, sizes)) * spans + np.repeat(owner, sizes)
    pairs, counts = np.unique(pairs, return_counts=True)
    owners, terms = pairs % spans, order[pairs // (spans * held)]
    named = rows.select([*SPAN, "dl"]).take(pa.array(starts[owners]))
    columns = [*named.columns, coded.dictionary.take(pa.array(terms)), pa.array(counts.astype(np.int64))]
    columns.append(rows.column("block").take(pa.array(starts[owners])))
    return pa.table(columns, names=_COUNTED), owners


def _owner(counts: pa.Table) -> list:
    return [counts.column(c)[0].as_py() for c in (*SPAN, "dl")]


def _merged(held: pa.Table, more: pa.Table) -> pa.Table:
    names = [c for c in _COUNTED if c != "tf"]
    both = pa.concat_tables([held, more]).group_by(names, use_threads=False).aggregate([("tf", "sum")])
    return pa.table([both.column("tf_sum" if c == "tf" else c) for c in _COUNTED], names=_COUNTED)


def doc_stats(index: LexicalIndex) -> DataFrame:
    """Length of every chunk in tokens after stop words; 0 for chunks without."""
    return index.postings.where(F.col("term") == CHUNK_MARK).select(*SPAN, "dl")


def _corpus_stats(postings: DataFrame) -> DataFrame:
    chunks = postings.where(F.col("term") == CHUNK_MARK)
    return chunks.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).alias("total_length"),
        F.avg("dl").alias("avgdl"),
    )


def _term_stats(postings: DataFrame, corpus_stats: DataFrame) -> DataFrame:
    df = F.col("df")
    n_docs = corpus_stats.select("n_docs").scalar()
    counts = postings.where(F.col("term") != CHUNK_MARK).groupBy("term").agg(F.count("*").alias("df"))
    return counts.select("term", "df", F.log1p((n_docs - df + 0.5) / (df + 0.5)).alias("idf"))


def _limits(postings: DataFrame) -> DataFrame:
    """For each term and block the largest count and the least length: no posting there weighs more than both give."""
    found = postings.where(F.col("term") != CHUNK_MARK).groupBy("term", "block")
    return found.agg(F.max("tf").alias("top_tf"), F.min("dl").alias("least_dl"))


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """Let tasks write bucketed rows in the order they come, unless the session already says how many files may be open."""
    held = spark.conf.get(_WRITERS, None)
    if not int(held or 0):
        spark.conf.set(_WRITERS, _WRITERS_OPEN)
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, held)


def write_index(
    chunks: DataFrame, path: str, buckets: int | None = None, blocks: int | None = None
) -> LexicalIndex:
    """Build an index of ``chunks`` at ``path`` in one pass over their text.

    Existing tables at ``path`` are replaced. The numbers of buckets and of
    blocks in each grow with the stored size of the chunks unless they are given.
    """
    spark = chunks.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = buckets or min(most, partitions_for(chunks, _BUCKET_BYTES))
    blocks = blocks or -(-partitions_for(chunks, _BLOCK_BYTES) // buckets)
    name = _table_name(path)
    counted = count_terms(chunks, buckets, blocks).selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]})" for c in _POSTING_COLUMNS.split(", ")]
    )
    # A task holds one bucket. Sorted here and not by the writer, which would sort by the bucket's number first
    # and work it out anew for both rows of every comparison.
    with _open_writers(spark):
        (
            counted.sortWithinPartitions("term", "block")
            .write.mode("overwrite")
            .option("path", f"{path}/postings")
            # Spans repeat once per term: a large dictionary stores each path once.
            .option("parquet.dictionary.page.size", 16 << 20)
            .bucketBy(buckets, *SPAN_KEY)
            .saveAsTable(name)
        )
    postings = spark.table(name)
    _corpus_stats(postings).withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(
        f"{path}/corpus_stats"
    )
    corpus_stats = spark.read.parquet(f"{path}/corpus_stats")
    _term_stats(postings, corpus_stats).sortWithinPartitions("term").write.mode("overwrite").parquet(
        f"{path}/term_stats"
    )
    _limits(postings).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/limits")
    return LexicalIndex(
        postings, spark.read.parquet(f"{path}/term_stats"), corpus_stats, spark.read.parquet(f"{path}/limits")
    )


def load_index(spark: SparkSession, path: str) -> LexicalIndex:
    """Open an index; a missing one is an error (``AnalysisException``)."""
    corpus_stats = spark.read.parquet(f"{path}/corpus_stats")
    buckets = corpus_stats.first()["buckets"]
    name = _table_name(path)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_POSTING_COLUMNS}) USING parquet "
        f"CLUSTERED BY ({', '.join(SPAN_KEY)}) SORTED BY (term, block) "
        f"INTO {buckets} BUCKETS LOCATION '{location}/postings'"
    )
    return LexicalIndex(
        spark.table(name), spark.read.parquet(f"{path}/term_stats"), corpus_stats, spark.read.parquet(f"{path}/limits")
    )


def drop_index(spark: SparkSession, path: str) -> None:
    """Forget the catalogue's entry of the index at ``path``; its files are not touched."""
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")


def build_index(chunks: DataFrame, buckets: int | None = None) -> LexicalIndex:
    """An index below the shared folder, for use within one application."""
    return write_index(chunks, new_folder(chunks.sparkSession, "index"), buckets)


def _table_name(path: str) -> str:
    # External tables: the catalogue entry carries the bucketing, the data
    # stays at the index path. One name per place, so opening adds none.
    return f"spanseek_postings_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def _saturation(index: LexicalIndex, tf: str = "tf", dl: str = "dl") -> Column:
    """The part of a weight that depends on the posting; it grows with ``tf`` and falls with ``dl``."""
    avgdl = index.corpus_stats.select("avgdl").scalar()
    norm = index.k1 * (1 - index.b + index.b * F.col(dl) / avgdl)
    return F.col(tf) / (F.col(tf) + norm)


def weighted_postings(index: LexicalIndex) -> DataFrame:
    """All postings with their weights.

    A small vocabulary is broadcast. For a large one, note that a term may hold
    a large share of the postings, but at most ``_HOT_SHARE`` terms can each
    hold more than ``1/_HOT_SHARE`` of them: those are broadcast, and the join
    by shuffle sees only terms below that share.
    """
    postings = index.postings.where(F.col("term") != CHUNK_MARK)
    stats = index.term_stats.select("term", "df", "idf")
    if is_small(stats):
        joined = postings.join(F.broadcast(stats), "term")
    else:
        is_hot = F.col("df") * _HOT_SHARE > stats.agg(F.sum("df")).scalar()
        split = postings.join(F.broadcast(stats.where(is_hot)), "term", "left")
        rest = split.where(F.col("df").isNull()).drop("df", "idf").join(stats.where(~is_hot), "term")
        joined = split.where(F.col("df").isNotNull()).unionByName(rest)
    return joined.select(*SPAN, "term", "tf", "dl", "df", (F.col("idf") * _saturation(index)).alias("weight"))


def query_weights(queries: DataFrame, index: LexicalIndex) -> DataFrame:
    """``(query_id, term, query_weight)``: repeats times idf; unknown terms vanish."""
    return _query_weights(queries, index).drop("df")


def _query_weights(queries: DataFrame, index: LexicalIndex) -> DataFrame:
    terms = queries.select("query_id", F.explode(query_terms(F.col("question"))).alias("term"))
    counted = terms.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))
    return counted.join(index.term_stats, "term").select(
        "query_id", "term", (F.col("qtf") * F.col("idf")).alias("query_weight"), "df"
    )


def _staged_weights(queries: DataFrame, index: LexicalIndex) -> DataFrame:
    return stage(_query_weights(queries, index), "query-weights")


def _weight_blocks(staged: DataFrame, max_rows: int) -> list[DataFrame]:
    """Query weights in blocks of whole queries, each small enough to broadcast."""
    weights = staged.drop("df")
    n, size = weights.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    blocks = max(1, -(-n // max_rows), -(-size // _BLOCK_TERM_BYTES))
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    return [F.broadcast(weights.where(number == block)) for block in range(blocks)]


def _block_scores(weights: DataFrame, index: LexicalIndex) -> DataFrame:
    hits = index.postings.join(weights, "term")
    part = F.col("query_weight") * _saturation(index)
    return hits.groupBy("query_id", *SPAN).agg(F.sum(part).alias("score"))


def bm25_scores(queries: DataFrame, index: LexicalIndex, max_block_rows: int = MAX_BLOCK_ROWS) -> DataFrame:
    """Score of every (query, chunk) pair that shares a term.

    ``queries`` is ``(query_id, question)`` with unique ids. However many they
    are, postings stay in their buckets: queries come in blocks that are
    broadcast, of about ``max_block_rows`` terms.
    """
    blocks = _weight_blocks(_staged_weights(queries, index), max_block_rows)
    return reduce(DataFrame.unionByName, [_block_scores(weights, index) for weights in blocks])


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.round("score", 6).desc(), *SPAN_KEY)
    positive = scores.where(F.col("score") > 0)
    return positive.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def block_bounds(weights: DataFrame, index: LexicalIndex) -> DataFrame:
    """``(query_id, block, bound)``: no chunk of the block scores more for the query."""
    bound = F.col("query_weight") * _saturation(index, "top_tf", "least_dl")
    return index.limits.join(weights, "term").groupBy("query_id", "block").agg(F.sum(bound).alias("bound"))


def _postings_of(wanted: DataFrame, index: LexicalIndex) -> DataFrame:
    """Postings of the blocks in ``wanted``; the scan is told them while they are few."""
    named = [r[0] for r in wanted.select("block").distinct().limit(_MAX_NAMED_BLOCKS + 1).collect()]
    return index.postings.where(F.col("block").isin(named)) if len(named) <= _MAX_NAMED_BLOCKS else index.postings


def _scores_in(wanted: DataFrame, weights: DataFrame, index: LexicalIndex) -> DataFrame:
    """Scores in the wanted ``(query_id, block)``, a table that may be broadcast."""
    hits = _postings_of(wanted, index).join(weights, "term")
    hits = hits.join(F.broadcast(wanted.select("query_id", "block")), ["query_id", "block"])
    part = F.col("query_weight") * _saturation(index)
    return hits.groupBy("query_id", *SPAN).agg(F.sum(part).alias("score"))


def open_blocks(bounds: DataFrame, first: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Blocks that may still hold one of the best ``k``, given the ``best`` of the blocks in ``first``."""
    reached = best.where(F.col("rank") == k).select("query_id", F.round("score", 6).alias("reached"))
    rest = bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti")
    # Sums in another order may differ in the last bits, and scores are compared to six decimals.
    return rest.join(reached, "query_id", "left").where(
        F.col("reached").isNull() | (F.col("bound") + 2e-6 >= F.col("reached"))
    ).drop("reached")


def _pruned_topk(weights: DataFrame, index: LexicalIndex, k: int, probes: int) -> DataFrame:
    """The best ``k`` without the postings of blocks that cannot matter."""
    bounds = stage(block_bounds(weights, index), "bounds")
    order = W.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    first = bounds.withColumn("place", F.row_number().over(order)).where(F.col("place") <= probes)
    first = stage(first.select("query_id", "block"), "first-blocks")
    best = stage(_best(_scores_in(first, weights, index), k), "first-scores")
    rest = stage(open_blocks(bounds, first, best, k), "open-blocks")
    if not is_small(rest):  # little can be skipped: all postings are scored
        return _best(_block_scores(weights, index), k)
    return _best(best.drop("rank").unionByName(_scores_in(rest, weights, index)), k)


def bm25_topk(
    queries: DataFrame,
    index: LexicalIndex,
    k: int,
    max_block_rows: int = MAX_BLOCK_ROWS,
    pruned: bool | None = None,
    probes: int = PROBES,
) -> DataFrame:
    """Best ``k`` chunks per query with a positive score, ``rank`` from 1.

    Scores equal to six decimals are ordered by span. A corpus with fewer than
    ``k`` hits gives what it has. Each block of queries is cut by itself: the
    rank filter becomes a group limit before the shuffle, so at most ``k`` rows
    per query leave a task and only one block's pairs exist at a time. ``k``
    above ``spark.sql.optimizer.windowGroupLimitThreshold`` gives the same rows
    without that early cut.

    ``pruned`` searches skip the postings of blocks of chunks that cannot reach
    a query's k-th score, after its ``probes`` most promising ones; the rows are
    the same. By default searches are pruned whose terms have many postings.
    """
    staged = _staged_weights(queries, index)
    if pruned is None:
        pruned = (staged.agg(F.sum("df")).first()[0] or 0) >= PRUNED_FROM
    if pruned:
        blocks = _weight_blocks(staged, max(1, max_block_rows // probes))
        return reduce(DataFrame.unionByName, [_pruned_topk(w, index, k, probes) for w in blocks])
    blocks = _weight_blocks(staged, max_block_rows)
    return reduce(DataFrame.unionByName, [_best(_block_scores(w, index), k) for w in blocks])
