"""recall@k of ranked spans under a context budget.

Everything stays in long form: one row per retrieved span (at most ten per
result) and one per distinct truth span. No group is ever gathered into a row,
so a question with very many truth spans, or very many results, is spread by
its files and rows. Retrieved and truth spans meet on (question, file), never
as all pairs of a question.

Results are ``(pos, question_id, question_str, retrieved_sources)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import CONTEXT_BUDGET, HIT_SHARE, RECALL_DEPTHS
from ..functions import two_decimals
from ..schemas import SPAN

_FIRST, _LAST = SPAN[1], SPAN[2]
_SAME_FILE = ["question_id", "file_path"]


@dataclass(frozen=True)
class Truth:
    """Ground truth without repeated questions.

    ``items``  question_id, n_truth (0 for unanswered questions)
    ``spans``  question_id, file_path, truth_first, truth_last, copies
    """

    items: DataFrame
    spans: DataFrame


def dedupe_truth(truth: DataFrame) -> DataFrame:
    """The last item (by ``pos``) of each question id."""
    last = F.max_by(F.struct("pos", "sources"), "pos").alias("last")
    return truth.groupBy("question_id").agg(last).select("question_id", "last.*")


def count_copies(spans: DataFrame) -> DataFrame:
    """Identical truth spans become one row with their number, before any join."""
    return spans.groupBy(
        *_SAME_FILE, F.col(_FIRST).alias("truth_first"), F.col(_LAST).alias("truth_last")
    ).agg(F.count("*").alias("copies"))


def truth_tables(truth: DataFrame) -> Truth:
    """``Truth`` from items ``(pos, question_id, sources)``."""
    unique = dedupe_truth(truth)
    items = unique.select("question_id", F.coalesce(F.size("sources"), F.lit(0)).alias("n_truth"))
    spans = unique.select("question_id", F.explode("sources").alias("s")).select("question_id", "s.*")
    return Truth(items, count_copies(spans))


def merge_copies(results: DataFrame, depth: int = max(RECALL_DEPTHS)) -> DataFrame:
    """Equal results of one question become one row, counted in ``n_results``.

    Repeats of a result are legitimate and each counts, but they score the
    same: partial aggregation folds them before the shuffle.
    """
    graded = results.select("pos", "question_id", F.slice("retrieved_sources", 1, depth).alias("spans"))
    return graded.groupBy("question_id", "spans").agg(
        F.min("pos").alias("result_id"), F.count("*").alias("n_results")
    )


def match_truth(results: DataFrame, truth: Truth) -> DataFrame:
    """Results whose question has truth; others do not count."""
    return results.join(truth.items, "question_id")


def rank_spans(merged: DataFrame) -> DataFrame:
    """One row per retrieved span with its rank from 1."""
    listed = merged.select("result_id", "question_id", F.posexplode("spans").alias("at", "s"))
    return listed.select("result_id", "question_id", (F.col("at") + 1).alias("rank"), "s.*")


def relevant_spans(ranked: DataFrame, truth: Truth) -> DataFrame:
    """Retrieved spans of files the question's truth names."""
    return ranked.join(truth.spans.select(*_SAME_FILE).distinct(), _SAME_FILE, "left_semi")


def _length() -> Column:
    return F.abs(F.col(_LAST) - F.col(_FIRST))


def _spend(spans: DataFrame, order: list, budget: int) -> DataFrame:
    """Keep spans in ``order`` while budget is left; shorten the one that overflows."""
    earlier = W.partitionBy("result_id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(_length()).over(earlier), F.lit(0))
    kept = spans.withColumn("prior", prior).where(F.col("prior") < budget)
    cut = (F.col(_FIRST) + budget - F.col("prior")).cast("int")
    return kept.withColumn(_LAST, F.when(F.col("prior") + _length() > budget, cut).otherwise(F.col(_LAST)))


def apply_budget(relevant: DataFrame, budget: int = CONTEXT_BUDGET) -> DataFrame:
    """Relevant spans within the budget, in rank order.

    What comes before a span does not depend on the depth, so one pass serves
    every k.
    """
    return _spend(relevant, [F.col("rank")], budget)


def fill_context(ranked: DataFrame, truth: Truth, budget: int = CONTEXT_BUDGET) -> DataFrame:
    """The whole selected context: relevant spans first, then other files'.

    Repeats of a span of another file are passed over. The second part never
    changes the score, because only truth files are compared; this table shows
    what would be given to a reader.
    """
    files = truth.spans.select(*_SAME_FILE).distinct().withColumn("relevant", F.lit(True))
    flagged = ranked.join(files, _SAME_FILE, "left").withColumn("relevant", F.coalesce("relevant", F.lit(False)))
    repeats = W.partitionBy("result_id", *SPAN).orderBy("rank")
    first_only = flagged.withColumn("copy", F.row_number().over(repeats)).where("relevant or copy = 1")
    return _spend(first_only.drop("copy"), [F.col("relevant").desc(), F.col("rank")], budget)


def span_overlap(kept: DataFrame, truth: Truth, depths: list[int] = RECALL_DEPTHS) -> DataFrame:
    """Characters of each truth span covered by the first k spans, ``overlap_k``."""
    shared = F.greatest(
        F.lit(0), F.least(_LAST, "truth_last") - F.greatest(_FIRST, "truth_first")
    )
    sums = [
        F.sum(F.when(F.col("rank") <= k, shared).otherwise(0)).alias(f"overlap_{k}") for k in depths
    ]
    pairs = kept.join(truth.spans, _SAME_FILE)
    return pairs.groupBy("result_id", *_SAME_FILE, "truth_first", "truth_last", "copies").agg(*sums)


def span_hits(overlaps: DataFrame, depths: list[int] = RECALL_DEPTHS) -> DataFrame:
    """Truth spans found per result, ``hits_k``; empty truth spans are never found."""
    length = F.abs(F.col("truth_last") - F.col("truth_first"))

    def hits(k: int) -> Column:
        found = (length > 0) & (F.col(f"overlap_{k}") / length >= HIT_SHARE)
        return F.sum(F.when(found, F.col("copies")).otherwise(0)).alias(f"hits_{k}")

    return overlaps.groupBy("result_id").agg(*[hits(k) for k in depths])


def question_recall(results: DataFrame, truth: Truth, depths: list[int] = RECALL_DEPTHS) -> DataFrame:
    """``recall_k`` of every distinct result of a known question.

    Found spans over all truth spans, repeated and empty ones included; 0 for a
    question without truth spans. ``results`` is read twice, so it should be a
    stored or staged table.
    """
    merged = merge_copies(results, max(depths))
    kept = apply_budget(relevant_spans(rank_spans(merged), truth))
    hits = span_hits(span_overlap(kept, truth, depths), depths)
    graded = match_truth(merged.drop("spans"), truth).join(hits, "result_id", "left")
    recalls = [
        F.coalesce(F.try_divide(F.col(f"hits_{k}"), F.col("n_truth")), F.lit(0.0)).alias(f"recall_{k}")
        for k in depths
    ]
    return graded.select("result_id", "question_id", "n_results", *recalls)


def recall_at_k(results: DataFrame, truth: Truth, depths: list[int] = RECALL_DEPTHS) -> DataFrame:
    """``(k, recall)``: mean over results of known questions, 0.0 if there are none."""
    scored = question_recall(results, truth, depths)
    means = [
        F.coalesce(
            F.try_divide(F.sum(F.col(f"recall_{k}") * F.col("n_results")), F.sum("n_results")), F.lit(0.0)
        ).alias(str(k))
        for k in depths
    ]
    return scored.agg(*means).unpivot([], [str(k) for k in depths], "k", "recall").withColumn(
        "k", F.col("k").cast("int")
    )


def evaluation_report(
    results: DataFrame, truth_items: DataFrame, truth: Truth, depths: list[int] = RECALL_DEPTHS
) -> DataFrame:
    """``(k, n_questions, recall)``: all items of the truth, recall to two decimals."""
    n_questions = truth_items.agg(F.count("*")).scalar()
    means = recall_at_k(results, truth, depths)
    return means.select("k", n_questions.alias("n_questions"), two_decimals(F.col("recall")).alias("recall"))
