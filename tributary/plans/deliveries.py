"""Streams that deliver to receivers, read from files as they appear, and run side by side."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import aggregates as A
from tributary.operators import filters as K
from tributary.operators import joins as J
from tributary.plans.registry import query
from tributary.plans.scalars import _STOCK_LINES, stock_lines
from tributary.plans.streams import staged
from tributary.session import streaming_session, work_dir
from tributary.sources import files
from tributary.streaming import monitor, sinks
from tributary.streaming.receivers import FolderReceiver, FolderWriter
from tributary.streaming.replay import for_each_batch, replay, run, stage

EVENT = "event_id bigint, event_type string, value double"
EVENTS = "SELECT event_id, event_type, value FROM events"


@query("stream_csv_stocks", "A1", f"""
    SELECT event_type AS company, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value FROM ({_STOCK_LINES}) WHERE event_id % 50 <> 0 AND event_id % 41 <> 0""")
def _(t):
    source = work_dir(t.spark, "stocks")
    stock_lines(t).where("event_id % 50 <> 0 and event_id % 41 <> 0").select("value").write.text(source)
    build = lambda spark: files.read_csv_stream(spark, source, "company string, date date, value double")
    return replay(t.spark, build).withColumn("date", F.col("date").cast("string"))


@query("stream_positions", "A31 A30", "SELECT event_id, 0 AS file_block_start FROM events")
def _(t):
    source = work_dir(t.spark, "positions")
    t("events", "event_id").write.parquet(source)
    build = lambda spark: files.with_file_position(files.read_rate_limited(spark, source, "event_id bigint", max_bytes=8_000_000))
    return replay(t.spark, build).select("event_id", F.col("file_block_start").cast("int").alias("file_block_start"))


@query("pushed_events", "A35 K3", EVENTS)
def _(t):
    out, s = work_dir(t.spark, "pushed"), staged(t)
    receiver = FolderReceiver(out, ["event_id", "event_type", "value"], "event_id")
    for_each_batch(t.spark, s.stream, sinks.push_partitions(receiver.send, chunk=1000))
    return t.spark.read.schema(EVENT).json(out)


@query("written_rows", "A20", EVENTS)
def _(t):
    out, s = work_dir(t.spark, "written"), staged(t)
    writer = FolderWriter(out, ["event_id", "event_type", "value"])
    stream = s.stream(streaming_session(t.spark)).writeStream.foreach(writer).trigger(availableNow=True)
    run(stream.option("checkpointLocation", work_dir(t.spark, "checkpoint")).start())
    return t.spark.read.schema(EVENT).json(out)


@query("paced_upserts", "A21", "SELECT first(event_id ORDER BY ts DESC, event_id DESC) AS event_id, event_type FROM events GROUP BY 2")
def _(t):
    out, s = work_dir(t.spark, "upserts"), staged(t)
    receiver = FolderReceiver(out, ["event_id", "event_type"], "event_type")
    build = lambda spark: s.stream(spark).select("event_type", "event_id", F.struct("ts", "event_id").alias("at"))
    for_each_batch(t.spark, build, sinks.rate_limited_upsert(receiver.upsert, "event_type", "at", 1000))
    return t.spark.read.schema("event_id bigint, event_type string").json(out)


@query("stream_sales_with_origin", "C4", """
    SELECT l_orderkey, l_linenumber, p_name AS car_name, l_extendedprice AS price, l_shipdate AS sold, p_brand AS origin
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    from tributary.functions.parsing import json_columns

    s = stage(t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"), "l_shipdate", 366 * 86400, f"{t.sf_dir}/sales")
    sale = F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("sold")))

    def build(spark):
        sent = s.stream(spark).select("l_orderkey", "l_linenumber", sale.alias("value"))
        sales = json_columns(sent, "value", "part bigint, price double, sold timestamp").withWatermark("sold", "1 hour")
        return J.join_on(sales, t("part", "p_partkey", "p_name", "p_brand"), "part", "p_partkey").select(
            "l_orderkey", "l_linenumber", F.col("p_name").alias("car_name"), "price", "sold", F.col("p_brand").alias("origin"))

    return replay(t.spark, build)


@query("stream_triggers", "H27", " UNION ALL ".join(f"SELECT '{kind}' AS kind, event_type, count(*) AS count FROM events GROUP BY 2" for kind in ("once", "every")))
def _(t):
    out, s, sibling = work_dir(t.spark, "triggers"), staged(t), streaming_session(t.spark)
    for kind, interval in (("once", None), ("every", "1 second")):
        writer = s.stream(sibling).writeStream.option("checkpointLocation", work_dir(t.spark, "checkpoint"))
        q = monitor.with_trigger(writer.foreachBatch(sinks.batch_counts(f"{out}/kind={kind}", "event_type")), kind, interval).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    counts = t.spark.read.schema("event_type string, count bigint, batch_id bigint, kind string").parquet(out)
    return counts.groupBy("kind", "event_type").agg(F.sum("count").alias("count"))


@query("streams_side_by_side", "H29", " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS count FROM events WHERE event_type = '{kind}'" for kind in ("view", "click", "purchase")))
def _(t):
    out, s, sibling = work_dir(t.spark, "side"), staged(t), streaming_session(t.spark)

    def starter(kind):
        rows = s.stream(sibling).where(F.col("event_type") == kind).select("event_id")
        writer = rows.writeStream.option("checkpointLocation", work_dir(t.spark, "checkpoint"))
        return lambda: monitor.with_trigger(writer.foreachBatch(sinks.exactly_once(f"{out}/kind={kind}")), "once").start()

    monitor.run_all([starter(kind) for kind in ("view", "click", "purchase")])
    return A.count_by(t.spark.read.schema("event_id bigint, batch_id bigint, kind string").parquet(out), "kind")


@query("routed_envelopes", "A37", """
    SELECT CASE WHEN user_id % 4 = 3 THEN 'unauthorized' WHEN user_id % 4 = 2 THEN 'unknown' ELSE 'science-tenant' || (user_id % 4) END AS topic,
        '{"session":"s' || user_id || '","time":' || epoch_us(ts) // 1000 || ',"tenant":"tenant' || (user_id % 4) || '","batch":' || user_id // 4
        || ',"index":' || event_id || ',"body":"' || event_type || '"}' AS value FROM events""")
def _(t):
    tenants = t.spark.createDataFrame([("tenant0", "key0", True), ("tenant1", "key1", True), ("tenant2", "key2", False)], "tenant_id string, key string, has_producer boolean")
    number = (F.col("user_id") % 4).cast("string")
    e = t("events").withColumns({
        "tenant": F.concat(F.lit("tenant"), number), "api_key": F.concat(F.lit("key"), number), "session": F.concat(F.lit("s"), F.col("user_id").cast("string")),
        "batch": F.floor(F.col("user_id") / 4)})
    routed = K.route_by_tenant(e, tenants, "tenant", "api_key")
    return routed.select("topic", K.envelope("session", "ts", "tenant", "event_type", "batch", "event_id").alias("value"))
