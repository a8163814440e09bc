"""Replayed streams return the whole table's result, in a bounded number of micro-batches."""

import datetime as dt

from pyspark.sql import functions as F

from tributary.plans import REGISTRY
from tributary.streaming.replay import stage


def events_dir(spark, tmp_path):
    """Five weeks of two users whose last rows come within the hour that the watermark holds back."""
    start = dt.datetime(2024, 1, 1)
    at = [i * 72_000 for i in range(40)] + [39 * 72_000 + 30 * k for k in range(1, 21)]
    rows = [(i, start + dt.timedelta(seconds=s), i % 2, "click", 150.0 + i % 7, "{}") for i, s in enumerate(at)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def both(spark, folder, stream, table):
    columns = sorted(REGISTRY[table](spark, folder).columns)
    plain = lambda name: sorted(map(repr, REGISTRY[name](spark, folder).select(*columns).collect()))
    return plain(stream), plain(table)


def test_the_last_hour_of_alerts_is_returned(spark, tmp_path):
    got, want = both(spark, events_dir(spark, tmp_path), "stream_fraud_alerts", "fraud_alerts")
    assert got == want and any("event_id=59," in r for r in want)


def test_the_last_hour_of_reports_is_returned(spark, tmp_path):
    got, want = both(spark, events_dir(spark, tmp_path), "stream_session_quality", "session_quality_reports")
    assert got == want and any("event_id=59," in r for r in want)


def test_slices_are_bounded_where_asked(spark, tmp_path):
    spark.range(500).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("ts", F.timestamp_seconds(F.col("id") * 50))
    few = stage(df, "ts", 100, "few", most=10)
    assert few.slices <= 10 and spark.read.parquet(few.path).count() == 500


def test_a_joined_table_is_not_staged_in_files_by_the_product_of_its_sides(spark, tmp_path):
    spark.range(200_000).withColumn("x", F.rand(1)).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    joined = df.join(df.withColumnRenamed("x", "y"), "id").withColumn("ts", F.timestamp_seconds("id"))
    staged = stage(joined, "ts", 100_000, "joined")
    assert staged.files_per_slice == 1 and spark.read.parquet(staged.path).count() == 200_000


def test_a_large_slice_has_several_files(spark, tmp_path):
    """Files of about 16 MB are written and read in parallel; every slice has the same number of them."""
    rows = spark.range(2_500_000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("ts", F.timestamp_seconds("id"))
    staged = stage(df, "ts", 1_250_000, "large")
    assert staged.files_per_slice >= 2 and len(spark.read.parquet(staged.path).inputFiles()) == staged.files_per_slice * staged.slices


def test_a_slice_of_few_rows_has_as_many_files_as_the_others(spark, tmp_path):
    rows = spark.range(2_500_000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    at = F.when(F.col("id") == 0, F.lit(-5_000_000)).otherwise(F.col("id"))
    staged = stage(spark.read.parquet(str(tmp_path / "t")).withColumn("ts", F.timestamp_seconds(at)), "ts", 1_250_000, "stray")
    assert len(spark.read.parquet(staged.path).inputFiles()) == staged.files_per_slice * staged.slices
