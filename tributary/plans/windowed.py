"""Window and ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.scalar import flatten_window, hashtags
from tributary.operators import ranking as R
from tributary.operators import windows as W
from tributary.plans.aggregations import DELAYED, delayed, with_batch
from tributary.plans.registry import query
from tributary.plans.scalars import post_text
from tributary.plans.sqltext import plus, slid, start

DAY, HOUR = 86400, 3600
TAGGED = "(SELECT event_id, ts, unnest(['#' || event_type, '#u' || (user_id % 10)]) AS tag FROM events)"
SENT = "(SELECT conv_id, turn, text, make_timestamp((1704067200 + conv_id * 20 + turn * 3) * 1000000) AS ts FROM conversations)"


def tagged(t):
    return hashtags(t("events", "event_id", "ts", "event_type", "user_id").select("ts", post_text().alias("text")), "text", "tag")


def sent(t):
    """Conversation turns with a sending time."""
    at = F.timestamp_seconds(1704067200 + F.col("conv_id") * 20 + F.col("turn") * 3)
    return t("conversations", "conv_id", "turn", "text").withColumn("ts", at)


def quantity(t, *more):
    return t("events", "ts", "value", *more).withColumn("quantity", F.floor("value"))


@query("tumbling_daily_totals", "H1", f"""
    SELECT {start(DAY)} AS start, {plus(start(DAY), DAY)} AS "end", CAST(sum(floor(value)) AS BIGINT) AS total FROM events GROUP BY ALL""")
def _(t):
    return W.tumbling(quantity(t), "ts", "1 day", {"total": ("sum", "quantity")})


@query("sliding_daily_totals", "H2", f"""
    SELECT ws AS start, we AS "end", CAST(sum(floor(value)) AS BIGINT) AS total FROM {slid('events', DAY, HOUR)} GROUP BY ALL""")
def _(t):
    return W.sliding(quantity(t), "ts", "1 day", "1 hour", {"total": ("sum", "quantity")})


@query("arrival_time_characters", "H3", f"""
    SELECT {start(600, 'arrival')} AS start, {plus(start(600, 'arrival'), 600)} AS "end", CAST(sum(length(props)) AS BIGINT) AS chars
    FROM {DELAYED} GROUP BY ALL""")
def _(t):
    return W.tumbling(delayed(t), "arrival", "10 minutes", {"chars": ("sum", F.length("props"))})


@query("windowed_count_of_millis", "H5 B27", f"""
    SELECT {start(600)} AS start, {plus(start(600), 600)} AS "end", count(*) AS count FROM events GROUP BY ALL""")
def _(t):
    from tributary.functions.scalar import from_epoch_ms

    e = t("events", "ts").select(F.unix_millis("ts").alias("millis")).withColumn("created", from_epoch_ms("millis"))
    return flatten_window(e.groupBy(F.window("created", "10 minutes")).agg(F.count("*").alias("count")))


@query("moving_average", "H6", f"""
    SELECT ws AS start, we AS "end", event_type, round(avg(value), 8) AS moving_average, count(value) AS event_count
    FROM {slid('events', DAY, 4 * HOUR)} GROUP BY ALL""")
def _(t):
    out = W.sliding(t("events", "ts", "event_type", "value"), "ts", "1 day", "4 hours",
                    {"moving_average": ("avg", "value"), "event_count": ("count", "value")}, ["event_type"])
    return out.withColumn("moving_average", F.round("moving_average", 8))


@query("rows_with_their_windows", "H7", f"""
    SELECT ws AS start, we AS "end", event_id FROM {slid('events', 2 * HOUR, HOUR)}""")
def _(t):
    return W.rows_in_window(t("events", "ts", "event_id"), "ts", "2 hours", "1 hour").select("start", "end", "event_id")


@query("count_by_sliding_window", "H8", f"""
    SELECT ws AS start, we AS "end", count(*) AS count FROM {slid('events', 60 * 60, 300)} GROUP BY ALL""")
def _(t):
    return W.sliding(t("events", "ts"), "ts", "60 minutes", "5 minutes", {"count": ("count", "*")})


@query("tiered_windows", "H10", f"""
    SELECT {start(HOUR)} AS start, event_type, count(*) AS count, 'critical_stream' AS source FROM events WHERE event_type = 'error' GROUP BY ALL
    UNION ALL SELECT {start(6 * HOUR)}, event_type, count(*), 'normal_stream' FROM events WHERE event_type = 'purchase' GROUP BY ALL
    UNION ALL SELECT {start(DAY)}, event_type, count(*), 'batch_stream' FROM events WHERE event_type = 'view' GROUP BY ALL""")
def _(t):
    from tributary.streaming.late import Tier, tiered_counts

    tiers = [Tier("critical", "error", "1 hour", "1 hour"), Tier("normal", "purchase", "6 hours", "6 hours"), Tier("batch", "view", "1 day", "1 day")]
    return tiered_counts(t("events", "ts", "event_type"), "ts", "event_type", tiers).drop("end")


@query("recommended_watermarks", "H13", f"""
    SELECT event_type, count(*) AS count, round(avg(latency_ms), 8) AS average, max(latency_ms) AS maximum, quantile_disc(latency_ms, 0.95) AS percentile,
      CASE WHEN count(*) < 10 THEN '5 seconds' WHEN quantile_disc(latency_ms, 0.95) > 10000 THEN '30 seconds'
           WHEN quantile_disc(latency_ms, 0.95) > 5000 THEN '15 seconds' ELSE '5 seconds' END AS watermark
    FROM {DELAYED} GROUP BY 1""")
def _(t):
    return W.recommend_watermark(delayed(t), "latency_ms", ["event_type"]).withColumn("average", F.round("average", 8))


@query("lag_per_window", "H15", f"""
    SELECT {start(DAY, 'arrival')} AS start, count(*) AS count, round(avg(lag), 8) AS avg_lag, min(lag) AS min_lag, max(lag) AS max_lag,
           quantile_disc(lag, 0.95) AS p95_lag
    FROM (SELECT *, epoch_us(arrival) // 1000000 - epoch_us(ts) // 1000000 AS lag FROM {DELAYED}) GROUP BY 1""")
def _(t):
    from tributary.functions.scalar import lag_seconds

    out = W.lag_monitor(delayed(t).withColumn("lag", lag_seconds("arrival", "ts")), "arrival", "lag", "1 day")
    return out.drop("end").withColumn("avg_lag", F.round("avg_lag", 8))


@query("message_throughput", "H16", f"""
    SELECT {start(60)} AS start, count(*) AS total_records, count(*) / 60.0 AS records_per_second, round(sum(length(text)) / 60.0, 8) AS bytes_per_second,
           round(avg(length(text)), 8) AS avg_record_size, round(sum(length(text)) / 1048576.0, 9) AS megabytes FROM {SENT} GROUP BY 1""")
def _(t):
    out = W.throughput(sent(t), "ts", "text", "1 minute").drop("end")
    return out.withColumns({"bytes_per_second": F.round("bytes_per_second", 8), "avg_record_size": F.round("avg_record_size", 8), "megabytes": F.round("megabytes", 9)})


@query("zscore_per_window", "H17", f"""
    SELECT start, count, round(a, 8) AS average, round(s, 8) AS std, lo AS minimum, hi AS maximum,
           abs(a - 50) / 10 > 2.0 OR abs(count - 100) / 100.0 > 0.5 OR coalesce(s, 0) > 20 AS anomaly
    FROM (SELECT {start(6 * HOUR)} AS start, count(value) AS count, avg(value) AS a, stddev(value) AS s, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1)""")
def _(t):
    out = W.zscore_windows(t("events", "ts", "value"), "ts", "value", "6 hours").drop("end")
    return out.withColumns({"average": F.round("average", 8), "std": F.round("std", 8)})


@query("recommended_intervals", "H18", f"""
    SELECT start, count, d AS duration_ms, round(r, 9) AS records_per_ms,
           CASE WHEN r > 1.0 THEN '5 seconds' WHEN r > 0.5 THEN '10 seconds' WHEN r > 0.1 THEN '20 seconds' ELSE '30 seconds' END AS interval
    FROM (SELECT start, count, d, count * 1.0::DOUBLE / (d + 1) AS r FROM (SELECT {start(HOUR)} AS start, count(*) AS count, max(event_id % 60) - min(event_id % 60) AS d
    FROM events GROUP BY 1))""")
def _(t):
    e = t("events", "ts", "event_id").withColumn("clock", F.col("event_id") % 60)
    return W.recommend_interval(e, "ts", "clock", "1 hour").drop("end").withColumn("records_per_ms", F.round("records_per_ms", 9))


@query("unusual_key_counts", "H19", f"""
    WITH c AS (SELECT {start(DAY)} AS start, user_id, count(*) AS count FROM events GROUP BY ALL),
    m AS (SELECT *, avg(count) OVER (PARTITION BY start) AS a FROM c)
    SELECT start, user_id, count, round(a, 8) AS avg_count FROM m WHERE count > 2 * a""")
def _(t):
    return W.count_anomalies(t("events", "ts", "user_id"), "ts", "user_id", "1 day").drop("end").withColumn("avg_count", F.round("avg_count", 8))


@query("length_sums_by_window", "H20", f"""
    SELECT ws AS start, CAST(sum(length(text)) AS BIGINT) AS chars FROM {slid(SENT, 60, 30)} GROUP BY 1""")
def _(t):
    return W.sliding(sent(t), "ts", "60 seconds", "30 seconds", {"chars": ("sum", F.length("text"))}).drop("end")


SENT_WORDS = f"(SELECT ts, unnest(string_split(text, ' ')) AS word FROM {SENT})"


def sent_words(t):
    from tributary.functions.scalar import words

    return sent(t).select("ts", words("text"))


@query("word_counts_by_window", "H21", f"""
    SELECT ws AS start, word, count(*) AS count FROM {slid(SENT_WORDS, 600, 300)} GROUP BY ALL""")
def _(t):
    return W.sliding(sent_words(t), "ts", "10 minutes", "5 minutes", {"count": ("count", "*")}, ["word"]).drop("end")


@query("expensive_words", "H22", f"""
    SELECT ws AS start, count(*) * 2 AS dollars FROM {slid(SENT_WORDS, 30, 10)} WHERE length(word) >= 10 GROUP BY ALL""")
def _(t):
    from tributary.operators.text import expensive_words

    return expensive_words(sent_words(t), "ts", "word").drop("end")


@query("sensor_outliers", "H23", f"""
    WITH b AS (SELECT event_type, epoch_us(ts) // 3600000000 AS slot, count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM events GROUP BY ALL),
    w AS (SELECT event_type, slot, sum(n) OVER o AS n, sum(s) OVER o AS s, sum(q) OVER o AS q FROM b
          WINDOW o AS (PARTITION BY event_type ORDER BY slot RANGE BETWEEN 23 PRECEDING AND CURRENT ROW)),
    m AS (SELECT event_type, slot, n, s / n AS mean, sqrt(greatest(q / n - (s / n) * (s / n), 0)) AS sd FROM w)
    SELECT event_id, e.event_type, value, round(mean, 8) AS mean, round(sd, 4) AS std FROM events e JOIN m
    ON e.event_type = m.event_type AND epoch_us(ts) // 3600000000 = slot WHERE n > 1 AND abs(value - mean) > 3 * sd""")
def _(t):
    out = W.sensor_outliers(t("events", "event_id", "event_type", "ts", "value"), "event_type", "ts", "value", "24 hours", "1 hour")
    return out.select("event_id", "event_type", "value", F.round("mean", 8).alias("mean"), F.round("std", 4).alias("std"))


SUSTAINED_SQL = f"""
    WITH m AS (SELECT ws, event_type, avg(value) AS a FROM {slid('events', 2 * HOUR, HOUR // 2)} GROUP BY ALL),
    h AS (SELECT *, epoch_us(ws) // 1800000000 AS no FROM m WHERE a > 60),
    i AS (SELECT *, no - row_number() OVER (PARTITION BY event_type ORDER BY no) AS island FROM h),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_type, island ORDER BY no) AS streak FROM i)
    SELECT ws AS start, event_type, round(a, 8) AS avg_load, streak FROM r WHERE streak >= 3"""


def _sustained(t, **options):
    out = W.sustained_load(t("events", "event_type", "ts", "value"), "event_type", "ts", "value", "2 hours", "30 minutes", 60.0, **options)
    return out.drop("end").withColumn("avg_load", F.round("avg_load", 8))


query("sustained_load", "H24", SUSTAINED_SQL)(_sustained)
query("sustained_load_split", "H24", SUSTAINED_SQL)(lambda t: _sustained(t, rows_per_task=20))


@query("average_text_length", "H25", f"""
    SELECT {start(5)} AS start, round(avg(length(text)), 8) AS avg_length FROM {SENT} GROUP BY 1""")
def _(t):
    return W.tumbling(sent(t), "ts", "5 seconds", {"avg_length": ("avg", F.length("text"))}).drop("end").withColumn("avg_length", F.round("avg_length", 8))


@query("adaptive_window_totals", "H14", f"""
    WITH b AS (SELECT *, epoch_us(ts) // 604800000000 AS batch_id FROM events), n AS (SELECT batch_id, count(*) AS velocity FROM b GROUP BY 1),
    w AS (SELECT b.*, velocity, CASE WHEN velocity > 2400 THEN 30 WHEN velocity > 2000 THEN 60 WHEN velocity > 100 THEN 300 ELSE 900 END AS size FROM b JOIN n USING (batch_id))
    SELECT batch_id, make_timestamp(epoch_us(ts) // (size * 1000000) * (size * 1000000)) AS start, size AS window_seconds, velocity, count(*) AS count,
           round(sum(value), 4) AS total FROM w GROUP BY ALL""")
def _(t):
    from tributary.operators.windows import adaptive_windows_by_batch

    e = with_batch(t("events", "ts", "value"))
    rules = [(2400, 30), (2000, 60), (100, 300)]
    return adaptive_windows_by_batch(e, "batch_id", "ts", "value", rules, 900).withColumn("total", F.round("total", 4))


SOLD = "(SELECT l_partkey, l_quantity, l_shipdate AS ts FROM lineitem)"


@query("best_sellers_per_day", "F1", f"""
    SELECT {start(DAY)} AS start, l_partkey, sum(l_quantity) AS total FROM {SOLD} GROUP BY ALL""")
def _(t):
    return R.best_sellers(t("lineitem", "l_partkey", "l_quantity", "l_shipdate"), "l_shipdate", "l_partkey", "l_quantity").drop("end")


@query("best_seller_of_each_day", "F1 E3", f"""
    WITH s AS (SELECT {start(DAY)} AS start, l_partkey, sum(l_quantity) AS total FROM {SOLD} GROUP BY ALL)
    SELECT start, l_partkey, total FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY total DESC, l_partkey) AS r FROM s) WHERE r = 1""")
def _(t):
    return R.best_seller(t("lineitem", "l_partkey", "l_quantity", "l_shipdate"), "l_shipdate", "l_partkey", "l_quantity").drop("end")


@query("best_sellers_24h_hourly", "F2", f"""
    SELECT ws AS start, event_type, CAST(sum(floor(value)) AS BIGINT) AS total FROM {slid('events', DAY, HOUR)} GROUP BY ALL""")
def _(t):
    return R.best_sellers(quantity(t, "event_type"), "ts", "event_type", "quantity", "1 day", "1 hour").drop("end")


@query("top_hashtags_by_window", "F3 E3", f"""
    WITH c AS (SELECT ws AS start, tag, count(*) AS count FROM {slid(TAGGED, 6 * HOUR, HOUR)} GROUP BY ALL)
    SELECT start, tag, count, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY count DESC, tag) AS r FROM c) WHERE r <= 5""")
def _(t):
    return R.top_hashtags(tagged(t), "ts", "tag", 5, "6 hours", "1 hour").drop("end")


@query("popular_hashtags", "F4", f"""
    SELECT ws AS start, tag, count(*) AS count FROM {slid(TAGGED, HOUR, 10 * 60)} GROUP BY ALL""")
def _(t):
    return R.popular_hashtags(tagged(t), "ts", "tag", "1 hour", "10 minutes").drop("end")


@query("most_active_users", "E3", """
    SELECT user_id, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, user_id LIMIT 10""")
def _(t):
    from tributary.operators.aggregates import count_by

    return R.top_k(count_by(t("events", "user_id"), "user_id"), "count", ["user_id"], 10)


CHEAPEST_SQL = """
    WITH b AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_quantity * 5 <= 100 THEN '0-100' WHEN l_quantity * 5 <= 150 THEN '101-150'
        WHEN l_quantity * 5 <= 200 THEN '151-200' ELSE '200+' END AS bracket FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice, bracket FROM
    (SELECT *, percent_rank() OVER (PARTITION BY bracket ORDER BY l_extendedprice) AS r FROM b) WHERE r <= 0.1"""


def _cheapest(t, **options):
    rows = t("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity").withColumn("power", F.col("l_quantity") * 5)
    return R.bottom_percent(rows, "power", "l_extendedprice", **options).select("l_orderkey", "l_linenumber", "l_extendedprice", "bracket")


query("cheapest_tenth_per_bracket", "E1", CHEAPEST_SQL)(_cheapest)
query("cheapest_tenth_split", "E1", CHEAPEST_SQL)(lambda t: _cheapest(t, rows_per_task=500))
