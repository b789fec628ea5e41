"""Time the headline jobs and print one JSON line.

The stages of the library's own workflow are timed one after another on the
tables in ``$BENCH_SF_DIR``: build a store, search it, answer and evaluate.
Every job is run to the end on all its rows; a small untimed round on the same
code warms up the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanseek.operators import evaluation, lexical
from spanseek.plans import commands, registry, tables
from spanseek.staging import new_folder, stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
DIRECT = [
    "extension_report",
    "decode_text",
    "chunk_text",
    "tokenize",
    "bm25_postings",
    "hash_embed",
    "knn_l2",
    "knn_cosine",
    "knn_lsh",
    "clean_answer",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        value = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        return value

    for name in DIRECT:
        timed(name, lambda: drain(registry.queries()[name](spark, sf_dir)))

    docs = tables.docs(spark, sf_dir)
    questions = tables.questions(spark, sf_dir)
    asked = questions.select(F.col("pos").alias("query_id"), "question")
    store = timed(
        "build_store",
        lambda: commands.build_store(commands.chunking.chunk_documents(docs), new_folder(spark, "bench")),
    )
    timed("bm25_topk", lambda: drain(lexical.bm25_topk(asked, store.index, 10)))
    question = questions.first()["question"]
    timed("search_one", lambda: drain(commands.search(spark, store, question)))
    results = timed("search_dataset", lambda: stage(commands.search_dataset(questions, store), "results"))
    timed("answer_dataset", lambda: drain(commands.answer_dataset(results, registry.stub_generator, docs)))
    timed("recall_at_k", lambda: drain(evaluation.recall_at_k(results, tables.truth(spark, sf_dir))))
    return seconds


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("spanseek-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(SF_DIR), "sf0.001")
    if os.path.isdir(warm):
        run(spark, warm)
    seconds = run(spark, SF_DIR)
    spark.stop()
    line = {
        "metric": "retrieval_workflow_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    sys.exit(main())
