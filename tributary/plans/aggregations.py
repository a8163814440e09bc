"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import aggregates as A
from tributary.operators.joins import join_back
from tributary.operators.ordered import collect_in_chunks
from tributary.plans.registry import as_text, query
from tributary.plans.sqltext import start

WEEK = 7 * 86400


def with_batch(df):
    """The week number stands for the micro-batch a row arrives in."""
    return df.withColumn("batch_id", F.floor(F.unix_seconds("ts") / WEEK))


BATCH = f"epoch_us(ts) // {WEEK * 1_000_000}"


@query("event_count", "D1", "SELECT count(*) AS count FROM events")
def _(t):
    return A.count_all(t("events"))


@query("number_aggregates", "D2 K5", """
    SELECT 'sum' AS name, round(sum(value), 4) AS result FROM events UNION ALL SELECT 'avg', round(avg(value), 8) FROM events
    UNION ALL SELECT 'min', min(value) FROM events UNION ALL SELECT 'max', max(value) FROM events
    UNION ALL SELECT 'stddev', round(stddev(value), 8) FROM events UNION ALL SELECT 'mean', round(avg(value), 8) FROM events""")
def _(t):
    # one pass over the table for all functions, then one row each
    fns = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev, "mean": F.mean}
    digits = {"sum": 4}
    wide = t("events", "value").agg(*[F.round(fn("value"), digits.get(n, 8)).alias(n) for n, fn in fns.items()])
    return wide.unpivot([], list(fns), "name", "result")


@query("aggregate_as_parameter", "K5 D2", "SELECT round(stddev(value), 8) AS agg_so_far FROM events")
def _(t):
    return A.aggregate_with(t("events", "value"), "value", lambda c: F.round(F.stddev(c), 8))


@query("events_per_type", "D3", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def _(t):
    return A.count_by(t("events", "event_type"), "event_type")


@query("average_price", "D4", "SELECT round(avg(p_retailprice), 8) AS average FROM part")
def _(t):
    return A.avg_of(t("part"), "p_retailprice").select(F.round("average", 8).alias("average"))


@query("customers_per_segment", "D5", "SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1")
def _(t):
    return A.count_by(t("customer", "c_mktsegment"), "c_mktsegment")


@query("average_price_per_size", "D6", """
    SELECT 'Size: ' || p_size || ', AvgPrice: ' || round(avg(p_retailprice), 6) || ', Count: ' || count(*) AS line
    FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL GROUP BY p_size""")
def _(t):
    out = A.avg_and_count_by(t("part"), "p_size", "p_retailprice")
    return out.select(
        F.concat(F.lit("Size: "), "p_size", F.lit(", AvgPrice: "), F.round("average", 6), F.lit(", Count: "), "count").alias("line")
    )


@query("rows_per_batch", "D7", f"SELECT {BATCH} AS batch_id, count(*) AS count FROM events GROUP BY 1")
def _(t):
    return A.count_by(with_batch(t("events", "ts")), "batch_id")


@query("values_per_batch", "D8", f"SELECT {BATCH} AS batch_id, event_type, count(*) AS count FROM events GROUP BY 1, 2")
def _(t):
    return A.count_by(with_batch(t("events", "ts", "event_type")), "batch_id", "event_type")


@query("reduced_per_key_and_batch", "D9", f"""
    SELECT {BATCH} AS batch_id, user_id, round(max(value), 4) AS reduced FROM events GROUP BY 1, 2""")
def _(t):
    return A.reduce_by_key(with_batch(t("events", "ts", "user_id", "value")), ["batch_id", "user_id"], "value", F.max)


@query("distinct_users_per_type", "D10", "SELECT event_type, count(DISTINCT user_id) AS \"distinct\" FROM events GROUP BY 1")
def _(t):
    return A.distinct_count(t("events", "event_type", "user_id"), "user_id", ["event_type"])


@query("approximate_users_within_5_percent", "D10", """
    SELECT event_type, true AS close FROM events GROUP BY 1""")
def _(t):
    e = t("events", "event_type", "user_id")
    sketch = A.distinct_count(e, "user_id", ["event_type"], exact=False, name="about")
    exact = A.distinct_count(e, "user_id", ["event_type"], name="exact")
    return sketch.join(exact, "event_type").select("event_type", (F.abs(F.col("about") - F.col("exact")) <= F.col("exact") * 0.05).alias("close"))


PERCENTILES_SQL = f"""
    SELECT {start(86400)} AS start, event_type, count(value) AS count, round(avg(value), 8) AS average, min(value) AS minimum,
           max(value) AS maximum, quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.9) AS p90,
           quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99
    FROM events GROUP BY 1, 2 HAVING count(value) >= 5"""


def _percentiles(t, **options):
    day = F.window("ts", "1 day").start.alias("start")
    out = A.percentile_table(t("events", "ts", "event_type", "value"), "value", [day, "event_type"], **options)
    return out.withColumn("average", F.round("average", 8))


query("value_percentiles_per_day", "D11", PERCENTILES_SQL)(_percentiles)
query("value_percentiles_split", "D11", PERCENTILES_SQL)(lambda t: _percentiles(t, rows_per_task=10))


@query("collected_values_per_window", "D12", f"""
    SELECT {start(6 * 3600)} AS start, array_to_string(list(event_type ORDER BY ts, event_id), ',') AS items, CAST(0 AS BIGINT) AS chunk
    FROM events GROUP BY 1""")
def _(t):
    e = t("events", "event_id", "ts", "event_type").withColumn("start", F.window("ts", "6 hours").start)
    return as_text(collect_in_chunks(e, ["start"], "ts", "event_type", ["ts", "event_id"]), "items")


@query("collected_values_in_chunks", "D12", f"""
    WITH p AS (SELECT {start(6 * 3600)} AS start, event_type, ts, event_id, row_number() OVER (PARTITION BY {start(6 * 3600)} ORDER BY ts, event_id) - 1 AS pos FROM events)
    SELECT start, CAST(pos // 7 AS BIGINT) AS chunk, array_to_string(list(event_type ORDER BY ts, event_id), ',') AS items FROM p GROUP BY start, pos // 7""")
def _(t):
    e = t("events", "event_id", "ts", "event_type").withColumn("start", F.window("ts", "6 hours").start)
    return as_text(collect_in_chunks(e, ["start"], "ts", "event_type", ["ts", "event_id"], chunk_size=7), "items")


@query("storage_ratio", "D13 I4", """
    SELECT event_type, round(sum(value) / sum(user_id), 8) AS ratio FROM events GROUP BY 1""")
def _(t):
    return A.ratio_of_sums(t("events", "event_type", "value", "user_id"), "event_type", "value", "user_id").withColumn("ratio", F.round("ratio", 8))


def _level(name: str, seconds: int) -> str:
    return f"""SELECT '{name}' AS granularity, {start(seconds)} AS start, {start(seconds)} + INTERVAL {seconds} SECOND AS "end",
        round(sum(value), 4) AS total, count(*) AS count, count(DISTINCT event_type) AS items, round(avg(value), 8) AS average
        FROM events GROUP BY ALL"""


@query("three_granularities", "D14 G1", " UNION ALL ".join([_level("minute", 60), _level("hour", 3600), _level("day", 86400)]))
def _(t):
    out = A.multi_granularity(t("events", "ts", "event_type", "value"), "ts", "event_type", "value")
    return out.withColumns({"total": F.round("total", 4), "average": F.round("average", 8)})


def delayed(t):
    """Events with a made-up arrival: some types come later than others."""
    late = F.col("event_id") % 13 * 1500 + F.when(F.col("event_type") == "error", 20000).otherwise(0)
    return t("events").withColumn("latency_ms", late).withColumn("arrival", F.timestamp_micros(F.unix_micros("ts") + F.col("latency_ms") * 1000))


DELAYED = """(SELECT *, event_id % 13 * 1500 + CASE WHEN event_type = 'error' THEN 20000 ELSE 0 END AS latency_ms,
    make_timestamp(epoch_us(ts) + (event_id % 13 * 1500 + CASE WHEN event_type = 'error' THEN 20000 ELSE 0 END) * 1000) AS arrival FROM events)"""


@query("latency_statistics", "D15", f"""
    SELECT event_type, count(*) AS count, round(avg(latency_ms), 8) AS average, max(latency_ms) AS maximum,
           quantile_disc(latency_ms, 0.95) AS percentile FROM {DELAYED} GROUP BY 1""")
def _(t):
    return A.value_stats(delayed(t), "latency_ms", ["event_type"]).withColumn("average", F.round("average", 8))


@query("characters_per_language", "D16", "SELECT lang, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1")
def _(t):
    return A.char_count(t("documents", "lang", "text"), "text", ["lang"])


@query("events_per_experiment", "D17", "SELECT event_type, count(*) AS total_events FROM events GROUP BY 1")
def _(t):
    return A.events_per_experiment(t("events", "event_type"), "event_type")


@query("active_sessions", "D17", """
    SELECT count(*) FILTER (epoch_us(TIMESTAMP '2024-01-01 12:00:00') - epoch_us(f) < 14400000000) AS active_sessions, count(*) AS sessions
    FROM (SELECT user_id, min(ts) AS f FROM events GROUP BY 1)""")
def _(t):
    asof = F.lit("2024-01-01 12:00:00").cast("timestamp")
    return A.active_sessions(t("events", "user_id", "ts"), "user_id", "ts", asof, 4 * 3600)


@query("union_of_counts", "G1", """
    SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS count FROM customer GROUP BY 2
    UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""")
def _(t):
    c = A.count_by(t("customer", "c_nationkey"), F.col("c_nationkey").alias("nation")).withColumn("kind", F.lit("customer"))
    s = A.count_by(t("supplier", "s_nationkey"), F.col("s_nationkey").alias("nation")).withColumn("kind", F.lit("supplier"))
    return A.union_all(c, s)


@query("distinct_types", "G2", "SELECT DISTINCT event_type FROM events")
def _(t):
    return A.distinct_values(t("events", "event_type"), "event_type")


@query("two_disjoint_parts", "G3", """
    SELECT value > 50 AS high, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    high, rest = A.partition_by_predicate(t("events", "value"), F.col("value") > 50)
    return A.union_all(
        high.agg(F.lit(True).alias("high"), F.count("*").alias("n")), rest.agg(F.lit(False).alias("high"), F.count("*").alias("n"))
    )


@query("rows_above_group_average", "C13", """
    SELECT event_id, event_type, round(a, 8) AS type_average FROM
    (SELECT event_id, event_type, value, avg(value) OVER (PARTITION BY event_type) AS a FROM events) WHERE value > 2 * a""")
def _(t):
    out = join_back(t("events", "event_id", "event_type", "value"), ["event_type"], a=F.avg("value"))
    return out.where(F.col("value") > 2 * F.col("a")).select("event_id", "event_type", F.round("a", 8).alias("type_average"))


@query("values_over_threshold", "B8", "SELECT event_id, value FROM events WHERE value > (SELECT avg(r_regionkey) * 50 FROM region)")
def _(t):
    from tributary.operators.filters import threshold_filter

    limit = t("region", "r_regionkey").agg((F.avg("r_regionkey") * 50).alias("threshold"))
    return threshold_filter(t("events", "event_id", "value"), "value", limit)
