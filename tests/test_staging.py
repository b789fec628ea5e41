import os

import pytest
from pyspark.sql import functions as F

from spanseek import folding, staging
from spanseek.operators import chunking


def test_staged_table_survives_its_source(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(10).write.parquet(source)
    staged = staging.stage(spark.read.parquet(source), "t")
    spark.range(3).write.mode("overwrite").parquet(source)
    assert staged.count() == 10


def test_scratch_removes_what_was_staged_in_it(spark):
    kept = staging.stage(spark.range(3), "kept")
    with staging.scratch(spark):
        inner = staging.new_folder(spark, "inner")
        spark.range(5).write.parquet(inner)
        assert spark.read.parquet(inner).count() == 5
    assert not os.path.exists(inner.removeprefix("file:")) and kept.count() == 3


def test_folders_are_new_and_shared(spark):
    one, two = staging.new_folder(spark, "x"), staging.new_folder(spark, "x")
    assert one != two and one.startswith(staging.shared_folder(spark))


@pytest.mark.parametrize("limit, hinted", [(10, True), (9, False)])
def test_broadcast_only_below_the_bound(spark, limit, hinted):
    df = staging.broadcast_if_small(spark.range(10), limit)
    assert ("broadcast" in df._jdf.queryExecution().analyzed().toString().lower()) == hinted


def test_partitions_follow_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    stored = spark.read.parquet(path)
    assert staging.partitions_for(stored, 1 << 40) == 8
    assert staging.partitions_for(stored, 10_000) > 30
    unknown = spark.createDataFrame([("a", 1)], "s string, i int").selectExpr("concat(s, s) AS s")
    assert staging.partitions_for(unknown, 1 << 20) == 8


def test_narrow_scans_are_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).coalesce(1).write.parquet(path)
    spread = staging.spread_if_narrow(spark.read.parquet(path), "id")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread.count() == 100
    wide = spark.range(100).repartition(20)
    assert staging.spread_if_narrow(wide, "id") is wide


def test_row_operators_work_on_a_stream(spark, tmp_path, rows):
    """Decoding, filtering and chunking keep no state, so a stream of files can use them."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    files = spark.createDataFrame(
        [("a.py", bytearray(b"x" * 400)), ("b.txt", bytearray(b"no"))], "path string, content binary"
    )
    files.write.parquet(source)

    def chunks(df):
        return chunking.chunk_documents(chunking.filter_extensions(chunking.decode_text(df)), 150)

    stream = chunks(spark.readStream.schema(files.schema).parquet(source))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination(60)
    assert rows(spark.read.parquet(target)) == rows(chunks(files))


def test_filter_holds_all_keys_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("dir/f"), "id").alias("path"))
    for bits, most in ((folding.MAX_FILTER_BITS, 0.02), (1 << 15, 0.6)):
        held = folding.membership_filter(keys, "path", bits)
        assert keys.where(held(F.col("path"))).count() == 5000
        others = spark.range(5000, 25000).select(F.concat(F.lit("dir/f"), "id").alias("path"))
        assert others.where(held(F.col("path"))).count() <= most * 20000
    none = folding.membership_filter(keys.where("false"), "path")
    assert keys.where(none(F.col("path"))).count() == 0


def test_texts_are_folded_and_given_back(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, ""), (5, None), (6, "b")], "id int, text string")
    seen = []

    def run(distinct):
        seen.append(distinct.count())
        return distinct.withColumn("made", F.coalesce(F.upper("text"), F.lit("none")))

    out = folding.once_per_text(frame, "text", run, "made")
    assert seen == [4] and out.columns == ["id", "text", "made"]
    assert rows(out, "id", "made") == [(1, "A"), (2, "A"), (3, "none"), (4, ""), (5, "none"), (6, "B")]
    assert folding.once_per_text(frame.where("false"), "text", run, "made").count() == 0
