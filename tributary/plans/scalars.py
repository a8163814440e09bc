"""Projections, filters, scalar functions and parsing."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import functions as F

from tributary.functions import parsing as P
from tributary.functions import scalar as S
from tributary.operators import columnar
from tributary.plans.registry import REGISTRY, as_text, query


@query("projected_weights", "B1", """
    SELECT l_orderkey, l_linenumber, l_quantity AS quantity, round(l_quantity / 2.2, 6) AS quantity_kg,
           round(l_extendedprice * (1 - l_discount), 4) AS net_price FROM lineitem""")
def _(t):
    return t("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity as quantity", "round(l_quantity / 2.2D, 6) as quantity_kg",
        "round(l_extendedprice * (1 - l_discount), 4) as net_price",
    )


@query("customers_outside_segment", "B2", """
    SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def _(t):
    return t("customer", "c_custkey", "c_mktsegment").where(S.not_equal("c_mktsegment", "BUILDING"))


@query("short_word_counts", "B3 B21", """
    WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
    SELECT doc_id, count(*) AS short_words FROM w WHERE length(word) <= 5 GROUP BY doc_id""")
def _(t):
    split = t("documents", "doc_id", "text").select("doc_id", S.words("text"))
    return split.where(S.at_most_chars("word", 5)).groupBy("doc_id").agg(F.count("*").alias("short_words"))


@query("numbers_from_text", "B4", """
    SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
           try_cast(o_orderpriority AS BIGINT) AS whole, try_cast(o_orderstatus AS DOUBLE) AS status FROM orders""")
def _(t):
    o = t("orders", "o_orderkey", "o_orderpriority", "o_orderstatus").withColumn("first", F.substring("o_orderpriority", 1, 1))
    return o.select(
        "o_orderkey", S.cast_number("first").alias("priority"), S.cast_number("o_orderpriority", "bigint").alias("whole"),
        S.cast_number("o_orderstatus", "double").alias("status"),
    )


@query("event_times_from_millis", "B5", """
    SELECT event_id, epoch_us(ts) // 1000 AS millis, make_timestamp(epoch_us(ts) // 1000 * 1000) AS created FROM events""")
def _(t):
    e = t("events", "event_id", "ts").select("event_id", F.unix_millis("ts").alias("millis"))
    return e.withColumn("created", S.from_epoch_ms("millis"))


@query("event_props_columns", "B6", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(t):
    return P.json_columns(t("events", "event_id", "props"), "props", "k bigint")


_NESTED = "id string, user struct<name: string, email: string>, payload string"


@query("json_valid_and_invalid", "B7", """
    SELECT CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'invalid' ELSE 'valid' END AS verdict,
           CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE event_type END AS name,
           count(*) AS n
    FROM events GROUP BY ALL""")
def _(t):
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.struct(F.col("event_type").alias("name"), F.lit(None).cast("string").alias("email")).alias("user"),
            F.col("props").alias("payload"),
        )
    )
    broken = F.when(F.col("event_id") % 97 == 0, "not json").when(F.col("event_id") % 89 == 0, " ").otherwise(line)
    lines = t("events", "event_id", "event_type", "props").select(broken.alias("value"))
    valid, invalid = P.split_valid_json(lines, "value", _NESTED)
    both = valid.select(F.lit("valid").alias("verdict"), F.col("user.name").alias("name")).unionByName(
        invalid.select(F.lit("invalid").alias("verdict"), F.lit(None).cast("string").alias("name"))
    )
    return both.groupBy("verdict", "name").agg(F.count("*").alias("n"))


@query("keys_by_remainder", "B9", """
    SELECT CAST(user_id % 100 AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    return t("events", "user_id").groupBy(S.key_mod("user_id").alias("key")).agg(F.count("*").alias("n"))


@query("fields_of_separated_lines", "B10", """
    SELECT event_id, event_type AS sensor, value AS reading, CAST(NULL AS VARCHAR) AS missing FROM events""")
def _(t):
    lines = t("events").select("event_id", F.concat_ws(",", "event_type", F.col("value").cast("string")).alias("line"))
    return lines.select(
        "event_id", S.split_field("line", 0).alias("sensor"), S.split_field("line", 1, kind="double").alias("reading"),
        S.split_field("line", 2).alias("missing"),
    )


@query("upper_and_prefixed", "B11 B12", """
    SELECT p_partkey, upper(p_name) AS name_upper, 'PROCESSED: ' || p_name AS processed FROM part""")
def _(t):
    return t("part").select(
        "p_partkey", F.upper("p_name").alias("name_upper"), F.concat(F.lit("PROCESSED: "), "p_name").alias("processed")
    )


@query("times_inside_text", "B13 B14", """
    SELECT event_id, date_trunc('second', ts) AS event_time,
           event_id % 7 * 3 AS lag_seconds, event_id % 7 * 3000 AS lag_millis
    FROM events WHERE event_id % 10 <> 0""")
def _(t):
    e = t("events", "event_id", "ts", "event_type")
    stamp = F.concat(F.col("event_type"), F.lit(",timestamp="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(",x"))
    lines = e.select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(stamp).alias("value"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 7 * 3)).alias("arrival"),
    )
    marked = lines.where(F.col("value").contains("timestamp=")).withColumn("event_time", S.extract_time("value"))
    return marked.select(
        "event_id", "event_time", S.lag_seconds("arrival", "event_time").alias("lag_seconds"),
        S.lag_millis("arrival", "event_time").alias("lag_millis"),
    )


@query("numeric_pieces", "B15", """
    WITH w AS (SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS piece FROM orders)
    SELECT o_orderkey, piece, CAST(piece AS DOUBLE) AS number FROM w WHERE regexp_full_match(piece, '\\d+')""")
def _(t):
    pieces = t("orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", F.explode(F.split("o_orderpriority", "-")).alias("piece")
    )
    return S.numeric_only(pieces, "piece")


@query("ids_from_prefix", "B16", "SELECT c_custkey, substr(c_name, 1, 3) AS user_prefix FROM customer")
def _(t):
    return t("customer", "c_custkey", "c_name").select("c_custkey", S.prefix_id("c_name").alias("user_prefix"))


@query("value_brackets", "B17", """
    SELECT CASE WHEN value <= 100 THEN '0-100' WHEN value <= 150 THEN '101-150' WHEN value <= 200 THEN '151-200'
                ELSE '200+' END AS bracket, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    return t("events", "value").groupBy(S.bracket("value").alias("bracket")).agg(F.count("*").alias("n"))


@query("ages_in_years", "B18", """
    SELECT o_orderkey, CAST(year(DATE '2024-06-15') - year(o_orderdate)
           - CASE WHEN strftime(DATE '2024-06-15', '%m%d') < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM orders""")
def _(t):
    asof = F.lit("2024-06-15").cast("date")
    return t("orders", "o_orderkey", "o_orderdate").select("o_orderkey", S.age_years("o_orderdate", asof).alias("age"))


@query("described_customers", "B19", """
    SELECT c_custkey, 'User ' || c_name || ' (' || c_nationkey || ' followers) says: ' || c_mktsegment AS line FROM customer""")
def _(t):
    c = F.col
    return t("customer").select("c_custkey", S.describe_post(c("c_name"), c("c_nationkey"), c("c_mktsegment")).alias("line"))


@query("exploded_names", "B20", """
    SELECT c_custkey, c_name AS field FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer""")
def _(t):
    return t("customer").select("c_custkey", S.explode_fields(["c_name", "c_mktsegment"]))


@query("word_rows", "B21", """
    SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations""")
def _(t):
    return t("conversations").select("conv_id", "turn", S.words("text"))


@query("high_balance_customers", "B22", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 8000")
def _(t):
    return t("customer", "c_custkey", "c_acctbal").where(S.above("c_acctbal", 8000))


@query("positional_lines", "B23", """
    SELECT o_orderkey AS id, o_orderstatus AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice AS price FROM orders""")
def _(t):
    lines = t("orders").select(
        F.concat_ws(
            ":", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice").cast("string")
        ).alias("value")
    )
    return as_text(P.parse_positional(lines, "value", "id bigint, status string, day date, price double"), "day")


@query("null_safe_filter", "B24", """
    SELECT event_id, value FROM events WHERE coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END, 0) > 140""")
def _(t):
    e = t("events", "event_id", "value").withColumn("seen", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    return e.where(S.null_safe_above("seen", 140)).select("event_id", "value")


@query("normalized_texts", "B25", r"""
    SELECT doc_id, regexp_replace(lower(text), '[^a-zA-Z0-9\s]', '', 'g') AS normalized FROM documents""")
def _(t):
    return t("documents", "doc_id", "text").select("doc_id", S.normalize_text("text").alias("normalized"))


def post_text():
    """A short post with two hashtags made from an event."""
    return F.concat(F.lit("saw #"), F.col("event_type"), F.lit(" by #u"), (F.col("user_id") % 10).cast("string"))


@query("hashtag_rows", "B26", """
    SELECT event_id, '#' || event_type AS hashtag FROM events
    UNION ALL SELECT event_id, '#u' || (user_id % 10) FROM events""")
def _(t):
    return S.hashtags(t("events").select("event_id", post_text().alias("text")), "text")


@query("doubled_ids", "B28", "SELECT event_id AS id, event_id * 2 AS doubled FROM events")
def _(t):
    return t("events", "event_id").select(F.col("event_id").alias("id"), (F.col("event_id") * 2).alias("doubled"))


@query("score_labels", "B29", """
    SELECT event_id, CASE WHEN s < 0 THEN 'NOT_UNDERSTOOD' WHEN s < 1 THEN 'VERY_NEGATIVE' WHEN s < 2 THEN 'NEGATIVE'
        WHEN s < 3 THEN 'NEUTRAL' WHEN s < 4 THEN 'POSITIVE' WHEN s < 5 THEN 'VERY_POSITIVE' ELSE 'NOT_UNDERSTOOD' END AS label
    FROM (SELECT event_id, value / 10 - 1 AS s FROM events)""")
def _(t):
    return t("events").select("event_id", S.sentiment_label(F.col("value") / 10 - 1).alias("label"))


@query("order_parts_lookup", "B30", """
    WITH o AS (SELECT l_orderkey, list(l_partkey) AS parts FROM lineitem GROUP BY 1)
    SELECT l_orderkey, unnest(parts) AS part, list_contains(parts, 42) AS has_part FROM o""")
def _(t):
    # an order has a handful of lines, so its list is small
    per_order = t("lineitem", "l_orderkey", "l_partkey").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("parts"))
    return per_order.select("l_orderkey", F.explode("parts").alias("part"), F.array_contains("parts", 42).alias("has_part"))


_STOCK_LINES = """
    SELECT event_id, CASE WHEN event_id % 50 = 0 THEN event_type || ',only-two-parts'
        WHEN event_id % 41 = 0 THEN event_type || ',invalid-date,' || value
        ELSE event_type || ',' || strftime(ts, '%b %-d %Y') || ',' || value END AS line, event_type, ts, value FROM events"""


def stock_lines(t):
    date = F.date_format("ts", "MMM d yyyy")
    value = F.col("value").cast("string")
    line = (
        F.when(F.col("event_id") % 50 == 0, F.concat("event_type", F.lit(",only-two-parts")))
        .when(F.col("event_id") % 41 == 0, F.concat_ws(",", "event_type", F.lit("invalid-date"), value))
        .otherwise(F.concat_ws(",", "event_type", date, value))
    )
    return t("events", "event_id", "ts", "event_type", "value").select("event_id", line.alias("value"))


@query("stock_lines_valid", "A32 A1", f"""
    SELECT event_id, event_type AS company, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value FROM ({_STOCK_LINES})
    WHERE event_id % 50 <> 0 AND event_id % 41 <> 0""")
def _(t):
    return as_text(P.dead_letter_csv(stock_lines(t))[0], "date")


@query("stock_lines_dead_letters", "A32", f"""
    SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'Malformed line: ' ELSE 'Error parsing line: ' END || line AS error
    FROM ({_STOCK_LINES}) WHERE event_id % 50 = 0 OR event_id % 41 = 0""")
def _(t):
    return P.dead_letter_csv(stock_lines(t))[1]


@query("orders_from_json", "A33", """
    SELECT CAST(o_orderkey AS VARCHAR) AS "orderId", CAST(o_custkey AS VARCHAR) AS "customerId",
           o_totalprice AS amount, epoch_ms(o_orderdate) AS timestamp FROM orders WHERE o_orderkey % 100 <> 0""")
def _(t):
    line = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("orderId"), F.col("o_custkey").cast("string").alias("customerId"),
            F.col("o_totalprice").alias("amount"), F.unix_millis("o_orderdate").alias("timestamp"),
        )
    )
    cut = F.when(F.col("o_orderkey") % 100 == 0, F.substring(line, 1, 20)).otherwise(line)
    return P.parse_orders_json(t("orders").select(cut.alias("value")))


def messages(t):
    """Events as key/value messages, the shape a message source delivers."""
    return t("events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.concat_ws(",", "event_type", F.col("value").cast("string")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )


@query("message_values", "A24", "SELECT 'events' AS topic, event_type || ',' || value AS \"actualValue\" FROM events")
def _(t):
    return P.message_values(messages(t))


@query("message_positions", "A31", """
    SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", event_type || ',' || value AS value FROM events""")
def _(t):
    return messages(t).select("partition", "offset", F.col("value").cast("string").alias("value"))


@query("part_key_values", "A25", "SELECT upper(p_name) AS key, p_name AS value FROM part")
def _(t):
    return P.to_key_value(t("part", "p_name"), F.upper("p_name"), F.col("p_name"))


@query("part_json_messages", "A26", """
    SELECT p_name AS key, p_name, CASE WHEN p_size > 25 THEN p_size END AS p_size, p_brand FROM part""")
def _(t):
    parts = t("part", "p_name", "p_size", "p_brand").withColumn("p_size", F.when(F.col("p_size") > 25, F.col("p_size")))
    sent = P.to_json_key_value(parts, "p_name", ["p_name", "p_size", "p_brand"])
    return P.json_columns(sent, "value", "p_name string, p_size int, p_brand string")


@query("order_sql_view", "A10", """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def _(t):
    from tributary.sources.files import run_sql

    return run_sql(
        t.spark, "select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from {orders} group by 1",
        orders=t("orders"),
    )


@query("word_rows_columnar", "B21 K1", REGISTRY["word_rows"].sql)
def _(t):
    return columnar.word_rows(t("conversations", "conv_id", "turn", "text"), ["conv_id", "turn"], "text")


@query("hashtag_rows_columnar", "B26 K1", REGISTRY["hashtag_rows"].sql)
def _(t):
    return columnar.word_rows(t("events").select("event_id", post_text().alias("text")), ["event_id"], "text", "hashtag", "#")


@query("gross_values_columnar", "K1", "SELECT event_id, round(value * 1.19::DOUBLE, 6) AS gross FROM events")
def _(t):
    gross = columnar.column_function(lambda v: pc.multiply(v, 1.19), "double")
    return t("events", "event_id", "value").select("event_id", F.round(gross("value"), 6).alias("gross"))
