"""Join queries and control-table filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import filters as K
from tributary.operators import joins as J
from tributary.plans.registry import as_text, query


@query("orders_with_customers", "C1", """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    return J.join_on(t("orders", "o_orderkey", "o_custkey"), t("customer", "c_custkey", "c_name", "c_mktsegment"), "o_custkey", "c_custkey").select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


# orders of every tenth customer are filed under a number that is no customer's, so that both sides have unmatched rows
_L, _R = "customer", "(SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders)"


def _sides(t):
    """All customers and all orders."""
    filed = F.when(F.col("o_custkey") % 10 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return t("customer", "c_custkey"), t("orders", "o_orderkey", "o_custkey").withColumn("o_custkey", filed)


for _how, _kind in {"left_outer": "LEFT", "right_outer": "RIGHT", "full_outer": "FULL"}.items():
    @query(f"customers_{_how}_orders", "C2", f"SELECT c_custkey, o_orderkey FROM {_L} {_kind} JOIN {_R} ON c_custkey = o_custkey")
    def _(t, how=_how):
        return J.join_on(*_sides(t), "c_custkey", "o_custkey", how).select("c_custkey", "o_orderkey")

for _how, _kind in {"left_semi": "SEMI", "left_anti": "ANTI"}.items():
    @query(f"customers_{_how}_orders", "C2", f"SELECT c_custkey FROM {_L} {_kind} JOIN {_R} ON c_custkey = o_custkey")
    def _(t, how=_how):
        return J.join_on(*_sides(t), "c_custkey", "o_custkey", how).select("c_custkey")


@query("sales_with_part_origin", "C4", """
    SELECT l_orderkey, l_linenumber, p_name AS car_name, l_extendedprice AS price, l_shipdate AS sold, p_brand AS origin
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    from tributary.functions.parsing import json_columns

    # the sale arrives as JSON text and is parsed before the lookup
    sale = F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("sold")))
    sales = json_columns(t("lineitem").select("l_orderkey", "l_linenumber", sale.alias("value")), "value", "part bigint, price double, sold timestamp")
    parts = t("part", "p_partkey", "p_name", "p_brand")
    return J.join_on(sales, parts, "part", "p_partkey").select(
        "l_orderkey", "l_linenumber", F.col("p_name").alias("car_name"), "price", "sold", F.col("p_brand").alias("origin")
    )


def views_and_clicks(e):
    v = e.where("event_type = 'view'").select(F.col("user_id").alias("view_user"), F.col("event_id").alias("view_id"), F.col("ts").alias("view_time"))
    c = e.where("event_type = 'click'").select(F.col("user_id").alias("click_user"), F.col("event_id").alias("click_id"), F.col("ts").alias("click_time"))
    return v, c


def _pairs(lo: int, hi: int) -> str:
    return f"""SELECT v.event_id AS view_id, c.event_id AS click_id, c.user_id FROM events v JOIN events c
        ON v.event_type = 'view' AND c.event_type = 'click' AND v.user_id = c.user_id
        AND c.ts BETWEEN v.ts + INTERVAL {lo} SECOND AND v.ts + INTERVAL {hi} SECOND"""


@query("clicks_after_views", "C7", _pairs(0, 12 * 3600))
def _(t):
    v, c = views_and_clicks(t("events", "event_id", "ts", "user_id", "event_type"))
    out = J.interval_join(v, c, "view_user", "click_user", "view_time", "click_time", 0, 12 * 3600)
    return out.select("view_id", "click_id", F.col("view_user").alias("user_id"))


@query("clicks_after_views_split", "C7", _pairs(0, 12 * 3600))
def _(t):  # buckets with more than one view of a user are cut
    v, c = views_and_clicks(t("events", "event_id", "ts", "user_id", "event_type"))
    out = J.interval_join(v, c, "view_user", "click_user", "view_time", "click_time", 0, 12 * 3600, rows_per_task=1)
    return out.select("view_id", "click_id", F.col("view_user").alias("user_id"))


@query("ends_after_starts", "C8", _pairs(600 * 60, 1800 * 60))
def _(t):
    v, c = views_and_clicks(t("events", "event_id", "ts", "user_id", "event_type"))
    out = J.interval_join(v, c, "view_user", "click_user", "view_time", "click_time", 600 * 60, 1800 * 60)
    return out.select("view_id", "click_id", F.col("view_user").alias("user_id"))


@query("views_with_recent_signup", "C9", """
    SELECT v.event_id AS view_id, s.event_id AS signup_id FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON v.user_id = s.user_id
    AND s.ts BETWEEN v.ts - INTERVAL 24 HOUR AND v.ts""")
def _(t):
    e = t("events", "event_id", "ts", "user_id", "event_type")
    v, _ = views_and_clicks(e)
    s = e.where("event_type = 'signup'").select(F.col("user_id").alias("signup_user"), F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_time"))
    return J.enrich_left_outer(v, s, "view_user", "signup_user", "view_time", "signup_time", 24 * 3600).select("view_id", "signup_id")


@query("sales_with_default_name", "C10", """
    SELECT l_orderkey, l_linenumber, coalesce(p_name, 'Unknown') AS p_name FROM lineitem
    LEFT JOIN part ON CASE WHEN l_linenumber = 7 THEN -l_partkey ELSE l_partkey END = p_partkey""")
def _(t):
    # seventh lines name a part that no table has
    named = F.when(F.col("l_linenumber") == 7, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    lines = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey").withColumn("l_partkey", named)
    return J.lookup_with_default(lines, t("part", "p_partkey", "p_name"), "l_partkey", "p_partkey", "p_name").select(
        "l_orderkey", "l_linenumber", "p_name"
    )


@query("views_and_clicks_grouped", "C12", """
    SELECT coalesce(v.user_id, c.user_id) AS user_id, CAST(0 AS BIGINT) AS chunk, coalesce(array_to_string(v.items, ','), '') AS left_items, coalesce(array_to_string(c.items, ','), '') AS right_items
    FROM (SELECT user_id, list(event_id ORDER BY ts) AS items FROM events WHERE event_type = 'view' GROUP BY 1) v
    FULL JOIN (SELECT user_id, list(event_id ORDER BY ts) AS items FROM events WHERE event_type = 'click' GROUP BY 1) c USING (user_id)""")
def _(t):
    e = t("events", "event_id", "ts", "user_id", "event_type")
    out = J.cogroup_lists(e.where("event_type = 'view'"), e.where("event_type = 'click'"), "user_id", "ts", "event_id", "event_id", ["ts"])
    return as_text(out, "left_items", "right_items")


KEYWORDS = ["ation", "Eaux", "wh "]


@query("texts_with_keywords", "A38", """
    SELECT doc_id FROM documents WHERE contains(lower(text), 'ation') OR contains(lower(text), 'eaux') OR contains(lower(text), 'wh ')""")
def _(t):
    return K.keyword_filter(t("documents", "doc_id", "text"), "text", KEYWORDS).select("doc_id")


@query("events_outside_pauses", "A39", """
    WITH p AS (SELECT TIMESTAMP '2024-01-01' + n_nationkey * INTERVAL 1 DAY AS at_, CASE WHEN n_regionkey % 2 = 0 THEN 'pause' ELSE 'resume' END AS command FROM nation),
    q AS (SELECT at_, command, lag(command, 1, 'resume') OVER (ORDER BY at_) AS prior FROM p),
    r AS (SELECT at_, command, lead(at_) OVER (ORDER BY at_) AS resumed FROM q WHERE command <> prior)
    SELECT event_id FROM events WHERE NOT EXISTS (SELECT 1 FROM r WHERE command = 'pause' AND ts >= at_ AND (resumed IS NULL OR ts < resumed))""")
def _(t):
    # the nations play the operator's commands, one a day
    commands = t("nation", "n_nationkey", "n_regionkey").select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("n_nationkey") * 86400).alias("at"),
        F.when(F.col("n_regionkey") % 2 == 0, "pause").otherwise("resume").alias("command"),
    )
    return K.pause_gate(t("events", "event_id", "ts"), commands, "ts", "at", "command").select("event_id")


TENANTS = [("tenant0", "key0", True), ("tenant1", "key1", True), ("tenant2", "key2", False)]


@query("events_routed_by_tenant", "A37", """
    SELECT CASE WHEN user_id % 4 = 3 OR event_type = 'error' THEN 'unauthorized' WHEN user_id % 4 = 2 THEN 'unknown'
           ELSE 'science-tenant' || (user_id % 4) END AS topic, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    tenants = t.spark.createDataFrame(TENANTS, "tenant_id string, key string, has_producer boolean")
    number = (F.col("user_id") % 4).cast("string")
    e = t("events").withColumns(
        {"tenant": F.concat(F.lit("tenant"), number), "api_key": F.when(F.col("event_type") == "error", "wrong").otherwise(F.concat(F.lit("key"), number))}
    )
    return K.route_by_tenant(e, tenants, "tenant", "api_key").groupBy("topic").agg(F.count("*").alias("n"))


@query("uploaded_lines", "A37", """
    WITH l AS (SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM conversations)
    SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS "index", ls[i] AS line FROM l, LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)""")
def _(t):
    return K.batch_upload_lines(t("conversations", "conv_id", "turn", "text"), "text")
