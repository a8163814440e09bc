"""Worked examples with known results."""

import pytest
from pyspark.sql import functions as F

from tributary.functions import parsing, scalar
from tributary.operators import aggregates, filters, keyed
from tributary.session import streaming_session, work_dir
from tributary.streaming import late, monitor, state
from tributary.streaming.replay import replay


# with one stateful operator per query, late rows are judged by the current watermark
CURRENT_WATERMARK = {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}


def steps(spark, batches, schema):
    """One file, so one micro-batch, per list of rows."""
    path = work_dir(spark, "golden")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return lambda s: s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def durations(values, first=0):
    return [("abc", first + i, v) for i, v in enumerate(values)]


def test_rolling_average(spark):
    df = spark.createDataFrame(durations([100, 200, 300, 400, 500, 600]), "s string, id long, x long").withColumn("ts", F.timestamp_seconds("id"))
    out = keyed.rolling_avg(df, "s", "ts", ["ts"], "x", 3).orderBy("id").collect()
    assert [r["rolling_avg"] for r in out] == [200, 300, 400, 500]


def test_rolling_average_across_batches(spark):
    source = steps(spark, [durations([1186, 615, 1497, 542, 720]), durations([768, 583, 485, 469, 566, 486], 5)], "s string, id long, x long")
    out = replay(spark, lambda s: state.rolling_avg(source(s), "s", ["id"], "id", "x")).orderBy("id").collect()
    means = [int(r["rolling_avg"] * 10) / 10 for r in out]
    assert means[:4] == [1099.3, 884.6, 919.6, 676.6] and len(means) == 9


def test_average_storage(spark):
    rows = [[("text", 3, 3000), ("text", 4, 5000), ("video", 1, 500000), ("audio", 3, 60000)], [("text", 1, 2500)]]
    source = steps(spark, rows, "kind string, n int, storage int")
    out = replay(spark, lambda s: aggregates.ratio_of_sums(source(s), "kind", "storage", "n"), "complete")
    assert {r["kind"]: r["ratio"] for r in out.collect()} == {"text": 1312.5, "video": 500000.0, "audio": 20000.0}


def test_nested_json(spark):
    lines = [
        '{"id":"1","user":{"name":"Ann","email":"a@b.c"},"timestamp":"2024-01-01T10:00:00","payload":"x"}',
        '{"id":"2","user":{"name":"Bob"},"timestamp":"2024-01-01T10:05:00","payload":"y"}', "not json", "",
    ]
    schema = "id string, user struct<name:string,email:string>, timestamp timestamp, payload string"
    valid, invalid = parsing.split_valid_json(spark.createDataFrame([(v,) for v in lines], "value string"), "value", schema)
    got = valid.orderBy("id").collect()
    assert [r["id"] for r in got] == ["1", "2"] and got[1]["user"]["email"] is None
    assert {r["value"] for r in invalid.collect()} == {"not json", ""}


def test_dead_letters(spark):
    lines = ["GOOG,May 1 2022,2300.50", "MSFT,invalid-date,300.0", "AMZN,only-two-parts"]
    valid, errors = parsing.dead_letter_csv(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert [(r["company"], str(r["date"]), r["value"]) for r in valid.collect()] == [("GOOG", "2022-05-01", 2300.5)]
    assert {r["error"] for r in errors.collect()} == {"Error parsing line: MSFT,invalid-date,300.0", "Malformed line: AMZN,only-two-parts"}


def test_tenants(spark):
    tenants = spark.createDataFrame([("tenant1", "key123", True), ("tenant3", "key789", False)], "tenant_id string, key string, has_producer boolean")
    calls = [("tenant1", "key123"), ("tenant1", "nope"), ("tenant1", None), ("tenant3", "key789"), ("tenant9", "key123")]
    out = filters.route_by_tenant(spark.createDataFrame(calls, "tenant string, api_key string"), tenants, "tenant", "api_key").collect()
    assert {(r["tenant"], r["api_key"]): r["topic"] for r in out} == dict(zip(calls, ["science-tenant1", "unauthorized", "unauthorized", "unknown", "unauthorized"]))


EXAMPLES = {
    1: (["7000,blue", "8000,green", "14000,blue", "9000,red", "15000,red 8000,blue", "13000,green", "21000,green", "4000,purple", "17000,green"],
        {(6000, "blue"), (8000, "green"), (12000, "green"), (14000, "red"), (14000, "blue")}, 4),
    2: (["5000,red 5000,green 4000,blue", "1000,yellow 2000,cyan 3000,magenta 5000,black", "10000,pink"],
        {(2000, "cyan"), (2000, "magenta"), (4000, "red"), (4000, "green"), (4000, "blue"), (4000, "black")}, 1),
    3: (["9000,blue", "2000,green 1000,blue 8000,red", "5000,red 18000,blue", "2000,green", "30000,purple 10000,green"],
        {(8000, "red"), (8000, "blue"), (18000, "blue")}, 5),
}


@pytest.mark.parametrize("example", EXAMPLES)
def test_watermarks(spark, example):
    groups, expected, dropped = EXAMPLES[example]
    batches = [[(int(r.split(",")[0]), r.split(",")[1]) for r in g.split()] for g in groups]
    source, seen = steps(spark, batches, "ms long, color string"), []

    def build(s):
        return late.watermarked_counts(source(s).select(scalar.from_epoch_ms("ms").alias("created"), "color"), "created", "color")

    out = replay(spark, build, conf=CURRENT_WATERMARK, on_finish=seen.append)
    rows = out.select(F.unix_millis("start").alias("ms"), "color", "count").collect()
    assert {(r["ms"], r["color"]) for r in rows} == expected and {r["count"] for r in rows} == {1}
    assert monitor.dropped_rows(seen[0]) == dropped


def test_late_rows_are_dropped_and_counted(spark):
    """Arrival order shuffled by hours: what a short delay drops, a long one keeps."""
    batches = [[(s,)] for s in (0, 3600, 7200, 1800, 10800, 5400, 14400, 36000)]
    source = steps(spark, batches, "sec long")

    def count(delay):
        seen = []
        build = lambda s: late.watermark_impact(
            source(s).select(F.timestamp_seconds("sec").alias("ts"), F.lit(1).alias("lag"), F.lit("x").alias("v")), "ts", "lag", "v", delay, "1 hour")
        out = replay(spark, build, conf=CURRENT_WATERMARK, on_finish=seen.append).agg(F.sum("count").alias("n")).first()["n"]
        return out, monitor.dropped_rows(seen[0])

    short, dropped = count("10 minutes")
    long, kept = count("10 hours")
    assert dropped == 2 and kept == 0 and short == 5
    assert (long or 0) <= short  # its last windows are still open


def test_recommended_watermark_levels(spark):
    from tributary.operators.windows import recommend_watermark, window_for_velocity

    def advice(values):
        return recommend_watermark(spark.createDataFrame([(v,) for v in values], "ms long"), "ms").first()["watermark"]

    assert advice([99999] * 9) == "5 seconds" and advice([10001] * 10) == "30 seconds"
    assert advice([10000] * 10) == "15 seconds" and advice([5000] * 10) == "5 seconds"
    assert [window_for_velocity(n) for n in (101, 100, 51, 50, 11, 10)] == ["30 seconds", "1 minute", "1 minute", "5 minutes", "5 minutes", "15 minutes"]


def test_labels_and_brackets(spark):
    df = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 1.0, 2.0, 3.0, 4.9, 5.0, 100.0, 100.5, 151.0, 200.5)], "v double")
    out = df.select(scalar.sentiment_label(F.col("v")).alias("s"), scalar.bracket("v").alias("b")).collect()
    assert [r["s"] for r in out][:7] == ["NOT_UNDERSTOOD", "VERY_NEGATIVE", "NEGATIVE", "NEUTRAL", "POSITIVE", "VERY_POSITIVE", "NOT_UNDERSTOOD"]
    assert [r["b"] for r in out][7:] == ["0-100", "101-150", "151-200", "200+"]


def test_state_settings(spark):
    sibling = streaming_session(spark)
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "2"  # a quarter of eight local cores
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert "RocksDB" in sibling.conf.get("spark.sql.streaming.stateStore.providerClass")
