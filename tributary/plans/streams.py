"""Streaming queries: the tables are replayed in weekly micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import aggregates as A
from tributary.operators import joins as J
from tributary.operators import keyed as K
from tributary.operators import sessions as S
from tributary.operators import windows as W
from tributary.plans.aggregations import BATCH, WEEK, delayed
from tributary.plans.histories import FRAUD_SQL, HOUR_US, ROLLING_SQL, SESSION_SQL, TREND_SQL, rounded
from tributary.plans.joined import views_and_clicks
from tributary.plans.registry import REGISTRY, as_text, query
from tributary.plans.sqltext import plus, sessioned, slid, start
from tributary.plans.windowed import TAGGED
from tributary.session import bounded_state, python_state, work_dir
from tributary.sources.tables import table_schema
from tributary.streaming import in_order, late, sinks, state, stored
from tributary.streaming.receivers import FolderReceiver
from tributary.streaming.replay import for_each_batch, replay, stage

DAY, HOUR = 86400, 3600
SLICE_NO = f"(SELECT *, dense_rank() OVER (ORDER BY {BATCH}) - 1 AS batch_id FROM events)"


def staged(t, **options):
    return stage(t("events"), "ts", WEEK, f"{t.sf_dir}/events", **options)


def watermark(delay_seconds: int, where: str = "true") -> str:
    """The last watermark: newest event time, in whole milliseconds, less the delay."""
    return f"(SELECT make_timestamp(max(epoch_us(ts)) // 1000 * 1000 - {delay_seconds * 1_000_000}) FROM events WHERE {where})"


@query("stream_daily_totals", "A8 A13 H1 H26", f"""
    SELECT {start(DAY)} AS start, {plus(start(DAY), DAY)} AS "end", CAST(sum(floor(value)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark).withColumn("quantity", F.floor("value"))
        return W.tumbling(e, "ts", "1 day", {"total": ("sum", "quantity"), "n": ("count", "*")})

    return replay(t.spark, build, "complete")


@query("stream_daily_totals_append", "H1 H26", f"""
    SELECT {start(DAY)} AS start, CAST(sum(floor(value)) AS BIGINT) AS total FROM events
    GROUP BY 1 HAVING {plus(start(DAY), DAY)} <= {watermark(HOUR)}""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark).withColumn("quantity", F.floor("value")).withWatermark("ts", "1 hour")
        return W.tumbling(e, "ts", "1 day", {"total": ("sum", "quantity")}).drop("end")

    return replay(t.spark, build)


@query("stream_moving_average", "H6", f"""
    SELECT ws AS start, event_type, round(avg(value), 8) AS moving_average, count(value) AS event_count
    FROM {slid('events', DAY, 4 * HOUR)} GROUP BY ALL HAVING any_value(we) <= {watermark(2 * HOUR)}""")
def _(t):
    s = staged(t)

    def build(spark):
        aggs = {"moving_average": ("avg", "value"), "event_count": ("count", "value")}
        e = s.stream(spark).withWatermark("ts", "2 hours")
        return W.sliding(e, "ts", "1 day", "4 hours", aggs, ["event_type"]).drop("end").withColumn("moving_average", F.round("moving_average", 8))

    return replay(t.spark, build)


@query("stream_purchase_sessions", "H4", f"""
    SELECT * FROM ({SESSION_SQL}) WHERE epoch_us(session_end) + 1859999999 <= epoch_us({watermark(HOUR)})""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark).withColumn("quantity", F.floor("value"))
        return S.purchase_sessions_stream(e, "user_id", "ts", "event_type", "quantity")

    return replay(t.spark, build)


@query("stream_watermarked_counts", "H9", f"""
    SELECT * FROM (SELECT {start(HOUR)} AS start, event_type, count(*) AS count FROM events GROUP BY ALL) WHERE {plus('start', HOUR)} <= {watermark(2 * HOUR)}""")
def _(t):
    s = staged(t)
    return replay(t.spark, lambda spark: late.watermarked_counts(s.stream(spark), "ts", "event_type", "2 hours", "1 hour").drop("end"))


@query("stream_enriched_events", "C3", """
    SELECT event_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey""")
def _(t):
    s = staged(t)

    def build(spark):
        customers = spark.read.schema(table_schema("customer")).parquet(f"{t.sf_dir}/customer.parquet").select("c_custkey", "c_name")
        return J.join_on(s.stream(spark).select("event_id", "user_id"), customers, "user_id", "c_custkey", "left").select("event_id", "c_name")

    return replay(t.spark, build)


def _order_lines(t, watermarked: bool):
    orders = stage(t("orders", "o_orderkey", "o_orderdate"), "o_orderdate", 4 * 365 * DAY, f"{t.sf_dir}/orders")
    lines = stage(t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", 4 * 365 * DAY, f"{t.sf_dir}/lineitem")

    kept, out = work_dir(t.spark, "sides"), work_dir(t.spark, "joined")
    late_rows = {"times": ("o_orderdate", "l_shipdate"), "delay_seconds": 60} if watermarked else {}
    write = stored.joined_to(t.spark, kept, out, "o_orderkey", "l_orderkey", ["o_orderkey", "l_linenumber"], **late_rows)
    for_each_batch(t.spark, lambda spark: stored.two_sides(orders.stream(spark), lines.stream(spark)), write)
    return t.spark.read.schema("o_orderkey bigint, l_linenumber int, batch_id bigint").parquet(out).drop("batch_id")


_ORDER_LINES = "SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey"


@query("stream_orders_with_lines", "C5", _ORDER_LINES)
def _(t):
    return _order_lines(t, False)


@query("stream_orders_with_lines_watermarked", "C6", _ORDER_LINES)
def _(t):
    return _order_lines(t, True)


@query("stream_clicks_after_views", "C7 C8", f"""
    SELECT v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c ON v.event_type = 'view' AND c.event_type = 'click'
    AND v.user_id = c.user_id AND c.ts BETWEEN v.ts AND v.ts + INTERVAL {12 * HOUR} SECOND""")
def _(t):
    s = staged(t)

    def build(spark):
        v, c = views_and_clicks(s.stream(spark))
        v, c = v.withWatermark("view_time", "10 minutes"), c.withWatermark("click_time", "10 minutes")
        return J.interval_join(v, c, "view_user", "click_user", "view_time", "click_time", 0, 12 * HOUR).select("view_id", "click_id")

    return replay(t.spark, build)


@query("stream_views_with_recent_signup", "C9", f"""
    WITH j AS (SELECT v.event_id AS view_id, v.ts, s.event_id AS signup_id FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON v.user_id = s.user_id AND s.ts BETWEEN v.ts - INTERVAL 24 HOUR AND v.ts)
    SELECT view_id, signup_id FROM j WHERE signup_id IS NOT NULL
    OR ts < least({watermark(HOUR, "event_type = 'view'")}, {watermark(HOUR, "event_type = 'signup'")})""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark)
        v, _ = views_and_clicks(e)
        g = e.where("event_type = 'signup'").select(F.col("user_id").alias("signup_user"), F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_time"))
        v, g = v.withWatermark("view_time", "1 hour"), g.withWatermark("signup_time", "1 hour")
        return J.enrich_left_outer(v, g, "view_user", "signup_user", "view_time", "signup_time", 24 * HOUR).select("view_id", "signup_id")

    return replay(t.spark, build)


@query("stream_unusual_key_counts", "H19", f"""
    WITH c AS (SELECT {start(DAY)} AS start, user_id, count(*) AS count FROM events GROUP BY ALL),
    m AS (SELECT *, avg(count) OVER (PARTITION BY start) AS a FROM c)
    SELECT start, user_id, count, round(a, 8) AS avg_count FROM m WHERE count > 2 * a AND {plus('start', DAY)} <= {watermark(HOUR)}""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark).withWatermark("ts", "1 hour")
        return W.count_anomalies(e, "ts", "user_id", "1 day").drop("end").withColumn("avg_count", F.round("avg_count", 8))

    return replay(t.spark, build)


TIERS = (
    late.Tier("critical", "error", "1 hour", "1 hour"), late.Tier("normal", "purchase", "6 hours", "6 hours"),
    late.Tier("batch", "view", "2 days", "1 day"),
)


@query("stream_tiered_counts", "H10 H29", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT {start(size)} AS start, event_type, count(*) AS count, '{name}_stream' AS source FROM events WHERE event_type = '{kind}'
    GROUP BY ALL) WHERE {plus('start', size)} <= {watermark(delay, f"event_type = '{kind}'")}"""
    for name, kind, delay, size in (("critical", "error", HOUR, HOUR), ("normal", "purchase", 6 * HOUR, 6 * HOUR), ("batch", "view", 2 * DAY, DAY))))
def _(t):
    s = staged(t)
    # one query per tier, so that the slowest watermark does not hold the others back
    parts = [
        replay(t.spark, lambda spark, tier=tier: late.tier_counts(s.stream(spark), "ts", "event_type", tier).drop("end")) for tier in TIERS
    ]
    return A.union_all(*parts)


@query("stream_watermark_impact", "H11", " UNION ALL ".join(
    f"""SELECT {start(DAY)} AS start, count(*) AS count, round(avg(event_id % 13), 8) AS avg_latency, max(event_id % 13) AS max_latency,
    count(DISTINCT event_type) AS unique_values, '{label}' AS setting FROM events GROUP BY 1 HAVING {plus(start(DAY), DAY)} <= {watermark(delay)}"""
    for label, delay in (("2_hours", 2 * HOUR), ("10_days", 10 * DAY))))
def _(t):
    s = staged(t)

    def build(spark, delay):
        e = s.stream(spark).withColumn("latency", F.col("event_id") % 13)
        return late.watermark_impact(e, "ts", "latency", "event_type", delay, "1 day").drop("end").withColumn("avg_latency", F.round("avg_latency", 8))

    return A.union_all(*[replay(t.spark, lambda spark, d=d: build(spark, d)) for d in ("2 hours", "10 days")])


@query("stream_late_rows", "H12 G3", f"""
    SELECT dense_rank() OVER (ORDER BY {BATCH}) - 1 AS batch_id, event_id, event_type FROM events
    QUALIFY event_id % 13 * 1500 + CASE WHEN event_type = 'error' THEN 20000 ELSE 0 END > 5000""")
def _(t):
    s, out = staged(t), work_dir(t.spark, "late")

    def split(batch):
        kept, behind = late.split_late(batch, "ts", "arrival", 5.0)
        per_window = W.tumbling(kept, "ts", "10 seconds", {"record_count": ("count", "*")})
        return {"on_time": per_window, "late": behind.select("event_id", "event_type")}

    def build(spark):
        return delayed(lambda _: s.stream(spark))

    for_each_batch(t.spark, build, sinks.split_to(out, split))
    return t.spark.read.schema("event_id bigint, event_type string, batch_id bigint").parquet(f"{out}/late")


@query("stream_adaptive_windows", "H14 K2", f"""
    WITH n AS (SELECT batch_id, count(*) AS velocity FROM {SLICE_NO} GROUP BY 1)
    SELECT batch_id, velocity, '30 seconds' AS window_size, count(*) AS count, round(sum(value), 4) AS total FROM {SLICE_NO} JOIN n USING (batch_id)
    GROUP BY ALL""")
def _(t):
    s, out = staged(t), work_dir(t.spark, "adaptive")

    def write(batch, n):
        batch.persist()
        W.adaptive_windows(batch, "ts", "value").write.mode("overwrite").parquet(f"{out}/batch_id={n}")
        batch.unpersist()

    for_each_batch(t.spark, s.stream, write)
    windows = t.spark.read.schema("start timestamp, total double, count bigint, window_size string, velocity bigint, batch_id bigint").parquet(out)
    return windows.groupBy("batch_id", "velocity", "window_size").agg(F.sum("count").alias("count"), F.round(F.sum("total"), 4).alias("total"))


@query("stream_latest_per_user", "A14", """
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1""")
def _(t):
    s = staged(t)
    schema = t("events", "user_id", "event_id", "event_type").schema
    table = sinks.KeyedTable(t.spark, work_dir(t.spark, "keyed"), ["user_id"], schema, compact_every=3)
    for_each_batch(t.spark, s.stream, table.upsert("event_id"))
    return table.read()


@query("stream_keyed_append", "A19", """
    SELECT event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY 1""")
def _(t):
    s = staged(t)
    schema = t("events", "event_type", "value", "event_id").schema
    table = sinks.KeyedTable(t.spark, work_dir(t.spark, "keyed"), ["event_type"], schema)
    for_each_batch(t.spark, lambda spark: s.stream(spark).select("event_type", "value", "event_id"), table.upsert("event_id"))
    return table.read()


@query("stream_view_counters", "A23", "SELECT user_id, count(*) AS view_count FROM events GROUP BY 1")
def _(t):
    s, out = staged(t), work_dir(t.spark, "counters")
    for_each_batch(t.spark, s.stream, sinks.counter_increments(out, "user_id"))
    return sinks.read_counters(t.spark, out, "user_id", "user_id bigint, count bigint, batch_id bigint")


@query("stream_counts_per_batch", "A36 D7 D8", f"SELECT batch_id, event_type, count(*) AS count FROM {SLICE_NO} GROUP BY ALL")
def _(t):
    s, out = staged(t), work_dir(t.spark, "batchcounts")
    for_each_batch(t.spark, s.stream, sinks.batch_counts(out, "event_type"))
    return t.spark.read.schema("event_type string, count bigint, batch_id bigint").parquet(out)


@query("stream_exactly_once_table", "A28", f"SELECT batch_id, event_id, value FROM {SLICE_NO}")
def _(t):
    s, out = staged(t), work_dir(t.spark, "once")
    write = sinks.exactly_once(out)

    def twice(batch, n):  # a retried batch replaces itself
        write(batch, n)
        write(batch, n)

    for_each_batch(t.spark, lambda spark: s.stream(spark).select("event_id", "value"), twice)
    return t.spark.read.schema("event_id bigint, value double, batch_id bigint").parquet(out)


@query("stream_json_folders", "A12 A2", f"SELECT CAST(batch_id AS BIGINT) AS batch, event_id, event_type, value FROM {SLICE_NO}")
def _(t):
    s, out = staged(t), work_dir(t.spark, "json")
    for_each_batch(t.spark, lambda spark: s.stream(spark).select("event_id", "event_type", "value"), sinks.json_per_batch(out))
    return t.spark.read.schema("event_id bigint, event_type string, value double, batch bigint").json(out)


@query("stream_text_folders", "A11 A4", f"""
    SELECT CAST(batch_id AS BIGINT) AS batch, event_type || ',' || user_id AS value FROM {SLICE_NO}""")
def _(t):
    s, out = staged(t), work_dir(t.spark, "text")
    build = lambda spark: s.stream(spark).select(F.concat_ws(",", "event_type", "user_id").alias("value"))
    for_each_batch(t.spark, build, sinks.text_per_batch(out))
    return t.spark.read.schema("value string, batch bigint").text(out)


@query("stream_json_source", "A2 A30", "SELECT event_id, ts, user_id, event_type FROM events")
def _(t):
    from tributary.sources.files import read_json_stream, write_json

    out = work_dir(t.spark, "jsonsource")
    write_json(t("events", "event_id", "ts", "user_id", "event_type"), out)
    return replay(t.spark, lambda spark: read_json_stream(spark, out, "event_id bigint, ts timestamp, user_id bigint, event_type string", 1))


@query("stream_tables_per_segment", "A22", """
    SELECT 'cars_' || regexp_replace(lower(c_mktsegment), '[^a-z0-9]', '', 'g') AS "table", c_custkey FROM customer""")
def _(t):
    out = work_dir(t.spark, "routed")
    source = work_dir(t.spark, "customers")
    t("customer", "c_custkey", "c_mktsegment").write.parquet(source)
    build = lambda spark: spark.readStream.schema("c_custkey bigint, c_mktsegment string").parquet(source)
    for_each_batch(t.spark, build, sinks.table_per_value(out, "c_mktsegment"))
    return t.spark.read.schema("c_custkey bigint, c_mktsegment string, batch_id bigint, table string").parquet(out).select("table", "c_custkey")


@query("merged_customers", "A18", """
    SELECT c_custkey, c_name, CASE WHEN o.price IS NOT NULL THEN o.price ELSE c_acctbal END AS c_acctbal FROM customer
    LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def _(t):
    batch = t("orders", "o_custkey", "o_totalprice", "o_orderkey").withColumnsRenamed({"o_custkey": "c_custkey", "o_totalprice": "c_acctbal"})
    return sinks.merge_upsert(t("customer", "c_custkey", "c_name", "c_acctbal"), batch, "c_custkey", ["c_acctbal"], "o_orderkey")


@query("appended_with_new_columns", "A17", """
    SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def _(t):
    old = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = t("supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("Name"), F.col("s_acctbal").alias("balance"))
    return sinks.append_evolving(old, new)


@query("acknowledged_chunks", "A34 K3", """
    SELECT count(*) AS total, true AS all_within_limit FROM lineitem""")
def _(t):
    # lines are sent in chunks to a receiver that keeps each chunk as a file
    receiver = FolderReceiver(work_dir(t.spark, "acknowledged"), ["l_orderkey", "l_linenumber"], "place")
    lines = t("lineitem", "l_orderkey", "l_linenumber").withColumn("place", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    acks = sinks.chunked_ack(lines, receiver.send, 100)
    return acks.agg(F.sum("size").alias("total"), (F.max("size") <= 100).alias("all_within_limit"))


# keyed state


def _micros(e):
    return e.withColumn("us", F.unix_micros("ts")).withColumn("x", F.col("value") * 10)


def until_watermark(sql: str) -> str:
    """The rows of a twin that the last watermark has passed: in-order streams hold back the others."""
    return f"SELECT * FROM ({sql}) WHERE event_id IN (SELECT event_id FROM events WHERE epoch_us(ts) <= epoch_us({watermark(HOUR)}))"


def _in_order(t, function, *arguments, whole: bool = False, **options):
    """A per-key history in order of event time, whatever the order of arrival; ``whole`` also releases what the last watermark holds back."""
    s = staged(t, closing_seconds=HOUR + 1) if whole else staged(t)
    buckets = in_order.buckets_for(s.rows, 16)
    build = lambda spark: function(_micros(s.stream(spark)), *arguments, delay="1 hour", buckets=buckets, **options)
    return replay(t.spark, build, conf=bounded_state(t.spark))


@query("stream_rolling_average", "I8 K4", until_watermark(ROLLING_SQL))
def _(t):
    return rounded(_in_order(t, in_order.rolling_avg, ["user_id"], "ts", "event_id", "x"), 8, "rolling_avg")


@query("stream_multi_window_trend", "I9", until_watermark(TREND_SQL))
def _(t):
    return rounded(_in_order(t, in_order.multi_window_trend, ["user_id"], "ts", "event_id", "x"), 8, "avg3", "avg5", "avg10")


@query("stream_fraud_alerts", "I6", FRAUD_SQL)
def _(t):
    return rounded(_in_order(t, in_order.fraud_alerts, ["user_id"], "ts", "event_id", "value", 3 * DAY, 8, 600.0, 4.0, whole=True), 4, "recent_total")


@query("stream_adaptive_threshold", "I7", until_watermark(f"SELECT * EXCLUDE (adjustments) FROM ({REGISTRY['adaptive_threshold_alerts'].sql})"))
def _(t):
    return rounded(_in_order(t, in_order.adaptive_threshold, ["user_id", "event_type"], "ts", "event_id", "value"), 7, "threshold")


@query("stream_baseline_anomalies", "I10", until_watermark(REGISTRY["baseline_anomalies"].sql))
def _(t):
    out = _in_order(t, in_order.baseline_anomalies, ["user_id"], "ts", "event_id", "x", 72 * HOUR)
    return rounded(rounded(out, 6, "zscore", "confidence"), 4, "expected_low", "expected_high")


@query("stream_session_quality", "I11", REGISTRY["session_quality_reports"].sql)
def _(t):
    return rounded(_in_order(t, in_order.session_quality, ["user_id"], "ts", "event_id", "x", whole=True), 6, "overall", "average")


@query("stream_rate_limit", "I16", until_watermark(REGISTRY["rate_limited_requests"].sql))
def _(t):
    return _in_order(t, in_order.rate_limit, ["user_id"], "ts", "event_id", 3, DAY)


@query("stream_session_expiry", "I2 I5 I15", f"""
    WITH s AS (SELECT user_id, s, max(ts) AS e, array_to_string(list(event_type ORDER BY ts), ',') AS actions FROM {sessioned('events', 12 * HOUR_US)} GROUP BY user_id, s),
    l AS (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY s) AS later FROM s)
    SELECT user_id, epoch_us(s) AS started, epoch_us(e) AS ended, actions FROM l
    WHERE later IS NOT NULL OR (epoch_us(e) + {12 * HOUR_US}) // 1000 * 1000 < epoch_us({watermark(HOUR)})""")
def _(t):
    s = staged(t)
    build = lambda spark: state.session_expiry(s.stream(spark).select("user_id", "ts", "event_type"), "user_id", "ts", "event_type", 12 * HOUR, "1 hour")
    return as_text(replay(t.spark, build, conf=python_state(t.spark)), "actions")


@query("stream_user_activity", "I1", REGISTRY["user_activity"].sql)
def _(t):
    s = staged(t)
    return replay(t.spark, lambda spark: K.user_activity(s.stream(spark), "user_id", "ts"), "update", ["user_id"])


@query("stream_count_alerts", "I3 D3", "SELECT event_type, count(*) AS count, count(*) > 5 AS alert FROM events GROUP BY 1")
def _(t):
    s = staged(t)
    return replay(t.spark, lambda spark: K.count_alert(s.stream(spark), "event_type"), "update", ["event_type"])


@query("stream_storage_ratio", "I4 D13", REGISTRY["storage_ratio"].sql)
def _(t):
    s = staged(t)
    return rounded(replay(t.spark, lambda spark: A.ratio_of_sums(s.stream(spark), "event_type", "value", "user_id"), "complete"), 8, "ratio")


@query("stream_trending_scores", "I12", f"""
    SELECT tag, round(sum(pow(0.95::DOUBLE, (m - epoch_us(ts)) / 3600000000.0)), 6) AS score FROM
    (SELECT *, max(epoch_us(ts)) OVER (PARTITION BY tag) AS m FROM {TAGGED}) GROUP BY 1""")
def _(t):
    from tributary.functions.scalar import hashtags
    from tributary.plans.scalars import post_text

    s = staged(t)

    def build(spark):
        posts = s.stream(spark).select(F.unix_micros("ts").alias("us"), post_text().alias("text"))
        return state.trending_decay(hashtags(posts, "text", "tag"), "tag", "us", unit_seconds=3600)

    return rounded(replay(t.spark, build, "update", ["tag"], conf=python_state(t.spark)), 6, "score").drop("at")


@query("stream_refreshed_names", "C11 C10 K2", f"""
    SELECT event_id, coalesce(CASE WHEN batch_id % 2 = 0 THEN s_name ELSE n_name END, 'N/A') AS name FROM {SLICE_NO}
    LEFT JOIN supplier ON user_id = s_suppkey LEFT JOIN nation ON user_id = n_nationkey""")
def _(t):
    from tributary.sources.tables import read_table
    from tributary.streaming.control import refreshing_lookup

    s, out = staged(t), work_dir(t.spark, "refreshed")

    def load(spark, n):  # the reference table is swapped between micro-batches
        if n % 2 == 0:
            return read_table(spark, t.sf_dir, "supplier", "s_suppkey", "s_name").toDF("id", "name")
        return read_table(spark, t.sf_dir, "nation", "n_nationkey", "n_name").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))

    build = lambda spark: s.stream(spark).select("event_id", "user_id")
    for_each_batch(t.spark, build, refreshing_lookup(load, "user_id", "id", "name", sinks.exactly_once(out)))
    return t.spark.read.schema("event_id bigint, name string, batch_id bigint").parquet(out).select("event_id", "name")


@query("stream_dynamic_threshold", "B8", f"SELECT event_id, value FROM {SLICE_NO} WHERE value > batch_id * 20")
def _(t):
    from tributary.streaming.control import dynamic_threshold

    s, out = staged(t), work_dir(t.spark, "threshold")
    load = lambda spark, n: spark.createDataFrame([(str(n * 20),)], "threshold string")
    for_each_batch(t.spark, lambda spark: s.stream(spark).select("event_id", "value"), dynamic_threshold(load, "value", sinks.exactly_once(out)))
    return t.spark.read.schema("event_id bigint, value double, batch_id bigint").parquet(out).select("event_id", "value")


@query("stream_progress", "H28", f"SELECT batch_id, count(*) AS input_rows FROM {SLICE_NO} GROUP BY 1")
def _(t):
    from tributary.streaming.monitor import progress_table

    s, seen = staged(t), []
    replay(t.spark, lambda spark: A.count_by(s.stream(spark), "event_type"), "complete", on_finish=seen.append)
    return progress_table(t.spark, *seen).where("input_rows > 0").select("batch_id", "input_rows")


@query("stream_messages", "A24 A30 B12", """
    SELECT 'events' AS topic, 'PROCESSED: ' || event_type || ',' || value AS processed FROM events""")
def _(t):
    from tributary.functions.parsing import message_values
    from tributary.plans.scalars import messages
    from tributary.sources.messages import read_message_files

    stored = work_dir(t.spark, "messages")
    messages(t).write.parquet(stored)

    def build(spark):
        return message_values(read_message_files(spark, stored)).select("topic", F.concat(F.lit("PROCESSED: "), "actualValue").alias("processed"))

    return replay(t.spark, build)


@query("static_json_customers", "A3", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    from tributary.sources.files import read_json_static, write_json

    out = work_dir(t.spark, "json")
    write_json(t("customer", "c_custkey", "c_name", "c_acctbal"), out)
    return read_json_static(t.spark, out, "c_custkey bigint, c_name string, c_acctbal double")


@query("stream_watched_folders", "A6 A7 A31", """
    SELECT event_type || ',' || user_id AS value, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    from tributary.sources.files import watch_many

    s, out = staged(t), work_dir(t.spark, "watched")
    build = lambda spark: s.stream(spark).select(F.concat_ws(",", "event_type", "user_id").alias("value"))
    for_each_batch(t.spark, build, sinks.text_per_batch(out))
    return replay(t.spark, lambda spark: watch_many(spark, f"{out}/batch=*", 1).select("value")).groupBy("value").agg(F.count("*").alias("n"))


@query("stream_resumed_after_restart", "A29 A28", "SELECT event_id, value FROM events")
def _(t):
    source, out, checkpoint = (work_dir(t.spark, kind) for kind in ("source", "resumed", "checkpoint"))
    e = t("events", "event_id", "ts", "value")
    middle = F.lit("2024-01-15").cast("timestamp")
    for part in (e.where(F.col("ts") < middle), e.where(F.col("ts") >= middle)):
        part.select("event_id", "value").write.mode("append").parquet(source)
        # a new query on the same checkpoint goes on after the files already done
        build = lambda spark: spark.readStream.schema("event_id bigint, value double").parquet(source)
        for_each_batch(t.spark, build, sinks.exactly_once(out), checkpoint=checkpoint)
    return t.spark.read.schema("event_id bigint, value double, batch_id bigint").parquet(out).select("event_id", "value")


@query("rows_mapped_in_pandas", "K1", "SELECT event_id, round(value * 1.19::DOUBLE, 6) AS gross FROM events WHERE value > 100")
def _(t):
    from tributary.operators.custom import map_rows

    def gross(pdf):
        big = pdf[pdf["value"] > 100]
        return big.assign(gross=big["value"] * 1.19)[["event_id", "gross"]]

    return rounded(map_rows(t("events", "event_id", "value"), gross, "event_id bigint, gross double"), 6, "gross")


@query("stream_top_types_per_batch", "K6 E3", f"""
    WITH c AS (SELECT batch_id, event_type, count(*) AS count FROM {SLICE_NO} GROUP BY ALL)
    SELECT batch_id, event_type, count FROM c QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY count DESC, event_type) <= 2""")
def _(t):
    from tributary.operators.custom import transform_batches
    from tributary.operators.ranking import top_k

    s, out = staged(t), work_dir(t.spark, "top")
    best = lambda batch: top_k(A.count_by(batch, "event_type"), "count", ["event_type"], 2)
    for_each_batch(t.spark, s.stream, transform_batches(best, sinks.exactly_once(out)))
    return t.spark.read.schema("event_type string, count bigint, batch_id bigint").parquet(out)


@query("stream_tailed_lines", "A40", "SELECT event_id || ',' || event_type AS value FROM events")
def _(t):
    from tributary.sources.tailing import TailedLines

    source, out = work_dir(t.spark, "tailed"), work_dir(t.spark, "lines")
    t("events").select(F.concat_ws(",", "event_id", "event_type").alias("value")).write.text(source)
    t.spark.dataSource.register(TailedLines)
    stream = t.spark.readStream.format("tailed_lines").option("path", source).load().select("value")
    query = stream.writeStream.option("checkpointLocation", work_dir(t.spark, "checkpoint")).foreachBatch(sinks.exactly_once(out)).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return t.spark.read.schema("value string, batch_id bigint").parquet(out).select("value")
