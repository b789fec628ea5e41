"""Fuse lexical and vector hits into one ranking.

A vector hit always scores the same constant, so the fused order has three
bands: lexical hits that reach the constant, vector hits, weaker lexical hits.
Rows are at most ``2 k`` per query, so every window here is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import VECTOR_SCORE
from ..schemas import SPAN, SPAN_KEY, span_type
from .lexical import LexicalIndex, bm25_topk
from .vectors import PROBED_SHARE, CellIndex, EmbedFactory, embed_text, knn, knn_lsh


def hybrid_candidates(lexical: DataFrame, nearest: DataFrame, vector_score: float = VECTOR_SCORE) -> DataFrame:
    """Lexical hits (origin 0) and vector hits (origin 1) with their ranks."""
    columns = ["query_id", *SPAN]
    first = lexical.where(F.col("score") > 0).select(
        *columns, "score", F.lit(0).alias("origin"), F.col("rank").alias("origin_rank")
    )
    second = nearest.select(
        *columns, F.lit(vector_score).alias("score"), F.lit(1).alias("origin"), F.col("rank").alias("origin_rank")
    )
    return first.unionByName(second)


def _fused_order() -> list:
    # Stable by score: ties go to the lexical side, then to the earlier rank.
    return [F.round("score", 6).desc(), F.col("origin"), F.col("origin_rank")]


def fuse(candidates: DataFrame) -> DataFrame:
    """Number the candidates of each query in fused order."""
    order = W.partitionBy("query_id").orderBy(*_fused_order())
    return candidates.withColumn("fused_rank", F.row_number().over(order))


def dedupe(fused: DataFrame) -> DataFrame:
    """Keep the highest place of each span start (file and first character)."""
    # query_id leads, so the partitioning of fuse() serves this window too.
    same = W.partitionBy("query_id", *SPAN_KEY).orderBy("fused_rank")
    return fused.withColumn("seen", F.row_number().over(same)).where("seen = 1").drop("seen")


def cut(fused: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows per query as ``(query_id, rank, span)``."""
    order = W.partitionBy("query_id").orderBy("fused_rank")
    ranked = fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", *SPAN)


def hybrid_topk(
    queries: DataFrame,
    index: LexicalIndex,
    vectors: CellIndex,
    k: int,
    embed_factory: EmbedFactory | None = None,
    share: float | None = PROBED_SHARE,
) -> DataFrame:
    """Ranked spans of each query, best ``k`` of both searches.

    The lexical side cleans the question, the vector side embeds it as it is
    and looks into ``share`` of the vectors; with ``None`` it is exact.
    """
    lexical = bm25_topk(queries, index, k)
    asked = embed_text(queries.select("query_id", "question"), "question", embed_factory)
    asked = asked.select("query_id", "embedding")
    if share is None:
        nearest = knn(asked, vectors.vectors, k, "l2", SPAN)
    else:
        nearest = knn_lsh(asked, vectors, k, SPAN, share)
    return cut(dedupe(fuse(hybrid_candidates(lexical, nearest))), k)


def pack_results(questions: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row per question with its spans in rank order, an empty list for none.

    ``questions`` has a unique ``pos``; ``ranked.query_id`` refers to it. At
    most ``k`` spans are gathered per question.
    """
    span = F.struct(*SPAN)
    lists = ranked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", span.alias("span")))).alias("r"))
    spans = F.transform("r", lambda r: r["span"])
    none = F.array().cast(f"array<{span_type.simpleString()}>")
    joined = questions.join(lists, questions["pos"] == lists["query_id"], "left")
    return joined.select(
        "pos",
        "question_id",
        F.col("question").alias("question_str"),
        F.coalesce(spans, none).alias("retrieved_sources"),
    )
