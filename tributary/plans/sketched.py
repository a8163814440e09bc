"""Windows from mergeable sketches, each checked against exact results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import heavy, sketches as S
from tributary.operators.aggregates import GRANULARITIES
from tributary.plans.aggregations import _level
from tributary.plans.registry import REGISTRY, query
from tributary.plans.sqltext import plus, slid, start
from tributary.plans.streams import DAY, HOUR, staged, watermark
from tributary.plans.windowed import tagged
from tributary.streaming.replay import replay

SHARES = {"median": 0.5, "p90": 0.9, "p99": 0.99}
# three times the error at 99 %: no honest run fails, a wrong merge does
BOUND = 3 * S.RANK_ERROR


def _within(rows, answers, keys):
    errors = S.rank_errors(rows, "value", keys, answers, SHARES)
    return errors.select(*keys, "n", *[(F.col(n) <= BOUND).alias(n) for n in SHARES])


@query("sketched_percentiles_per_day", "D11 H15", f"""
    SELECT {start(DAY)} AS start, event_type, count(value) AS n, true AS median, true AS p90, true AS p99 FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def _(t):
    e = t("events", "ts", "event_type", "value")
    hours = S.panes(e, "ts", "1 hour", ["event_type"], {"sketch": S.quantile_sketch("value")})
    days = S.sketched_quantiles(S.merged(hours, "1 day", ["event_type"], {"sketch": S.quantile_merge()}), SHARES)
    return _within(e.withColumn("start", F.window("ts", "1 day").start), days, ["start", "event_type"])


@query("sketched_percentiles_sliding", "D11 H13", f"""
    SELECT ws AS start, event_type, count(value) AS n, true AS median, true AS p90, true AS p99 FROM {slid('events', DAY, 6 * HOUR)} WHERE value IS NOT NULL GROUP BY 1, 2""")
def _(t):
    e = t("events", "ts", "event_type", "value")
    panes = S.panes(e, "ts", "2 hours", ["event_type"], {"sketch": S.quantile_sketch("value")})
    windows = S.merged(panes, "1 day", ["event_type"], {"sketch": S.quantile_merge()}, "6 hours", "2 hours")
    rows = e.withColumn("start", F.window("ts", "1 day", "6 hours").start)
    return _within(rows, S.sketched_quantiles(windows, SHARES), ["start", "event_type"])


@query("stream_sketched_percentiles", "D11 H15", f"""
    SELECT {start(DAY)} AS start, event_type, count(value) AS n, true AS median, true AS p90, true AS p99 FROM events WHERE value IS NOT NULL
    GROUP BY 1, 2 HAVING {plus(start(DAY), DAY)} <= {watermark(HOUR)}""")
def _(t):
    s = staged(t)

    def build(spark):
        e = s.stream(spark).withWatermark("ts", "1 hour")
        hours = S.panes(e, "ts", "1 hour", ["event_type"], {"sketch": S.quantile_sketch("value")})
        return S.merged(hours, "1 day", ["event_type"], {"sketch": S.quantile_merge()})

    days = replay(t.spark, build)
    rows = t("events", "ts", "event_type", "value").withColumn("start", F.window("ts", "1 day").start)
    return _within(rows, S.sketched_quantiles(days, SHARES), ["start", "event_type"])


@query("three_granularities_sketched", "D10 D14 H17", " UNION ALL ".join([_level("minute", 60), _level("hour", 3600), _level("day", 86400)]))
def _(t):
    out = S.granularities(t("events", "ts", "event_type", "value"), "ts", "event_type", "value", GRANULARITIES)
    return out.withColumns({"total": F.round("total", 4), "average": F.round("average", 8)})


AUDIENCES_SQL = f"""WITH u AS (SELECT DISTINCT {start(7 * DAY)} AS start, event_type, user_id FROM events)
    SELECT a.start, a.event_type AS one, b.event_type AS two, count(*) AS users, true AS close
    FROM u a JOIN u b ON a.start = b.start AND a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY ALL"""


def _overlaps(t, sketches):
    """Exact overlaps and whether the sketches' are within three standard errors of the union."""
    e = t("events", "ts", "event_type", "user_id").withColumn("start", F.window("ts", "7 days", None, "4 days").start)
    members = e.select("start", "event_type", "user_id").distinct()
    pairs = members.alias("a").join(members.alias("b"), ["start", "user_id"]).where("a.event_type < b.event_type")
    exact = pairs.groupBy("start", F.col("a.event_type").alias("one"), F.col("b.event_type").alias("two")).agg(F.count("*").alias("users"))
    about = S.overlaps(sketches, ["start"], "event_type")
    bound = F.greatest(F.lit(0.5), F.col("either") * (3.0 / 2 ** (S.AUDIENCE_LG / 2)))
    return exact.join(about, ["start", "one", "two"], "left").select("start", "one", "two", "users", F.coalesce(F.abs(F.col("shared") - F.col("users")) <= bound, F.lit(False)).alias("close"))


WEEKS = AUDIENCES_SQL.replace(start(7 * DAY), f"make_timestamp((epoch_us(ts) - {4 * DAY * 1_000_000}) // {7 * DAY * 1_000_000} * {7 * DAY * 1_000_000} + {4 * DAY * 1_000_000})")


@query("audience_overlaps", "D10 H17", WEEKS)
def _(t):
    e = t("events", "ts", "event_type", "user_id")
    days = S.panes(e, "ts", "1 day", ["event_type"], {"sketch": S.audience_sketch("user_id")})
    weeks = days.groupBy(F.window("window", "7 days", None, "4 days").start.alias("start"), "event_type").agg(S.audience_merge().alias("sketch"))
    return _overlaps(t, weeks)


def _top(t, **options):
    return heavy.top_items(tagged(t), "ts", "tag", 5, "6 hours", "1 hour", **options).drop("end")


# the second form holds 4 counters a pane, so that most windows are proven by few counters or counted in full
query("top_hashtags_by_summary", "F3 F4", REGISTRY["top_hashtags_by_window"].sql)(_top)
query("top_hashtags_by_small_summary", "F3 F4", REGISTRY["top_hashtags_by_window"].sql)(lambda t: _top(t, counters=4))
