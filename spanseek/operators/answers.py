"""Context, prompt and answer for retrieved spans.

Ranked spans are ``(query_id, rank, span)``; a query has at most k of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GENERATION_OPTIONS, PROMPT_HEAD, PROMPT_MIDDLE, PROMPT_TAIL
from ..folding import membership_filter, once_per_text
from ..functions import clean_answer, strip
from ..schemas import SPAN
from ..staging import MAX_BROADCAST_ROWS, is_small, stage

# Generator plug-in: called once per Python worker, returns
# (prompts, **options) -> completions.
GeneratorFactory = Callable[[], Callable[..., list[str]]]


def unpack_results(results: DataFrame) -> DataFrame:
    """Nested result lists to ``(query_id, rank, span)``; ``pos`` is the query id."""
    listed = results.select(F.col("pos").alias("query_id"), F.posexplode("retrieved_sources").alias("at", "s"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), "s.*")


def fetch_spans(ranked: DataFrame, docs: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add the text of each span; spans of unknown files are skipped.

    Offsets count characters of the normalised text. The distinct paths are
    stored first; if they are few by count and bytes they are broadcast. If not,
    a filter of bounded size made of them is applied where documents are read,
    so that texts of files nobody quotes do not move in either case. A document
    is read once however many spans quote it.
    """
    span = F.struct("query_id", "rank", *SPAN[1:])
    paths = stage(ranked.select("file_path").distinct(), "paths")
    texts = docs.select("file_path", "text")
    if is_small(paths, max_rows):
        texts = texts.join(F.broadcast(paths), "file_path", "left_semi")
    else:
        texts = texts.where(membership_filter(paths, "file_path")(F.col("file_path")))
    length = F.col("last_character_index") - F.col("first_character_index")
    piece = F.substring(F.col("text"), F.col("first_character_index") + 1, F.greatest(length, F.lit(0)))
    joined = ranked.select("file_path", span.alias("s")).join(texts, "file_path")
    return joined.select("s.*", "file_path", "text").select(
        "query_id", "rank", *SPAN, piece.alias("content")
    )


def build_context(fetched: DataFrame) -> DataFrame:
    """``(query_id, context)``: source and stripped text of each span in rank order."""
    part = F.concat(F.lit("Source: "), "file_path", F.lit("\nContent: "), strip(F.col("content")))
    parts = F.sort_array(F.collect_list(F.struct("rank", part.alias("part"))))
    context = F.array_join(F.transform(parts, lambda p: p["part"]), "\n\n")
    return fetched.groupBy("query_id").agg(context.alias("context"))


def prompt(context: Column, query: Column) -> Column:
    """The fixed template around context and query."""
    return F.concat(F.lit(PROMPT_HEAD), context, F.lit(PROMPT_MIDDLE), query, F.lit(PROMPT_TAIL))


def build_prompt(results: DataFrame, contexts: DataFrame) -> DataFrame:
    """Results with ``prompt``; a result without readable span has an empty context."""
    joined = results.join(contexts, results["pos"] == contexts["query_id"], "left").drop("query_id")
    context = F.coalesce("context", F.lit(""))
    question = F.coalesce("question_str", F.lit(""))
    return joined.withColumn("prompt", prompt(context, question)).drop("context")


def generate(prompts: DataFrame, generator_factory: GeneratorFactory) -> DataFrame:
    """Replace ``prompt`` by ``raw_answer`` from the caller's generator.

    The model is built once per Python worker and gets each distinct prompt
    once. The options ask for a greedy, short completion that does not echo the
    prompt.
    """

    @F.pandas_udf("string")
    def complete(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = generator_factory()
        for texts in batches:
            yield pd.Series(model(texts.tolist(), **GENERATION_OPTIONS), dtype=object)

    answered = lambda distinct: distinct.withColumn("raw_answer", complete(F.col("prompt")))
    # Read twice: for the distinct prompts, and to give the answers back.
    return once_per_text(stage(prompts, "prompts"), "prompt", answered, "raw_answer").drop("prompt")


def answer_results(results: DataFrame, docs: DataFrame, generator_factory: GeneratorFactory) -> DataFrame:
    """Answer every stored result: context, prompt, generation, cleaning."""
    contexts = build_context(fetch_spans(unpack_results(results), docs))
    raw = generate(build_prompt(results, contexts), generator_factory)
    return raw.withColumn("answer", clean_answer(F.col("raw_answer"))).drop("raw_answer")
