"""Sessions and per-key histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import keyed as K
from tributary.operators import sessions as S
from tributary.plans.registry import as_text, query
from tributary.plans.sqltext import sessioned, slid
from tributary.plans.windowed import TAGGED, quantity, tagged

HOUR_US = 3_600_000_000


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def clicks(t):
    """Events as answers of a session: the value in milliseconds."""
    return t("events", "event_id", "ts", "user_id", "value").withColumn("x", F.col("value") * 10)


CLICKS = "(SELECT event_id, ts, user_id, value * 10 AS x FROM events)"
SESSION_SQL = f"""SELECT user_id, s AS session_start, max(ts) AS session_end, CAST(sum(floor(value)) AS BIGINT) AS total_quantity,
    count(DISTINCT event_type) AS unique_items, (epoch_us(max(ts)) - epoch_us(s)) // 60000000 AS duration_minutes
    FROM {sessioned('events', 31 * 60 * 1_000_000)} GROUP BY user_id, s"""


def _purchases(t, **options):
    return S.purchase_sessions(quantity(t, "user_id", "event_type"), "user_id", "ts", "event_type", "quantity", **options)


query("purchase_sessions", "H4", SESSION_SQL)(_purchases)
query("purchase_sessions_split", "H4", SESSION_SQL)(lambda t: _purchases(t, rows_per_task=30))


@query("session_actions", "I2", f"""
    SELECT user_id, s AS session_start, CAST(0 AS BIGINT) AS chunk, array_to_string(list(event_type ORDER BY ts), ',') AS actions,
           (epoch_us(max(ts)) - epoch_us(s)) // 1000000 AS seconds FROM {sessioned('events', 12 * HOUR_US)} GROUP BY user_id, s""")
def _(t):
    return as_text(S.session_actions(t("events", "user_id", "ts", "event_type"), "user_id", "ts", "event_type", 12 * 3600), "actions")


@query("session_summary", "I5", f"""
    SELECT user_id, s AS session_start, max(ts) AS session_end, count(*) AS total_events, count(DISTINCT event_type) AS unique_types,
           epoch_us(max(ts)) // 1000 - epoch_us(s) // 1000 AS duration_ms FROM {sessioned('events', 6 * HOUR_US)} GROUP BY user_id, s""")
def _(t):
    return S.session_summary(t("events", "user_id", "ts", "event_type"), "user_id", "ts", "event_type", 6 * 3600)


@query("session_seconds", "I15", f"""
    SELECT user_id, s AS session_start, (epoch_us(max(ts)) - epoch_us(s)) // 1000000 AS seconds
    FROM {sessioned('events', 24 * HOUR_US)} GROUP BY user_id, s""")
def _(t):
    return S.session_seconds(t("events", "user_id", "ts"), "user_id", "ts", 24 * 3600)


@query("user_activity", "I1", "SELECT user_id, count(*) AS actions, max(ts) AS last_seen FROM events GROUP BY 1")
def _(t):
    return K.user_activity(t("events", "user_id", "ts"), "user_id", "ts")


@query("nation_count_alerts", "I3", "SELECT c_nationkey, count(*) AS count, count(*) > 60 AS alert FROM customer GROUP BY 1")
def _(t):
    return K.count_alert(t("customer", "c_nationkey"), "c_nationkey", 60)


@query("running_sums", "I17", """
    SELECT event_type, count(value) AS n, round(sum(value), 4) AS total, round(sum(value * value), 3) AS total_squares FROM events GROUP BY 1""")
def _(t):
    out = K.running_sums(t("events", "event_type", "value"), "event_type", "value")
    return rounded(rounded(out, 4, "total"), 3, "total_squares")


ROLLING_SQL = f"""SELECT user_id, event_id, round(a, 8) AS rolling_avg FROM
    (SELECT user_id, event_id, avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 2 PRECEDING) AS a,
            row_number() OVER (PARTITION BY user_id ORDER BY ts) AS p FROM {CLICKS}) WHERE p >= 3"""


def _rolling(t, **options):
    out = K.rolling_avg(clicks(t), "user_id", "ts", ["ts", "event_id"], "x", 3, **options)
    return rounded(out.select("user_id", "event_id", "rolling_avg"), 8, "rolling_avg")


# the *_split queries cut keys into buckets of a few rows and have the twins of the plain ones
query("rolling_average", "I8 E2", ROLLING_SQL)(_rolling)
query("rolling_average_split", "I8 E2", ROLLING_SQL)(lambda t: _rolling(t, rows_per_task=30))


TREND_SQL = f"""WITH m AS (SELECT user_id, event_id, row_number() OVER w AS p, avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 2 PRECEDING) AS a,
    avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 4 PRECEDING) AS b, avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 9 PRECEDING) AS c
    FROM {CLICKS} WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT user_id, event_id, round(a, 8) AS avg3, round(b, 8) AS avg5, round(c, 8) AS avg10,
    CASE WHEN a < b AND b < c THEN 'improving' WHEN a > b AND b > c THEN 'degrading'
         WHEN abs(a - b) < 50 AND abs(b - c) < 50 THEN 'stable' ELSE 'fluctuating' END AS trend FROM m WHERE p >= 10"""


@query("multi_window_trend", "I9", TREND_SQL)
def _(t):
    out = K.multi_window_trend(clicks(t), "user_id", "ts", ["ts", "event_id"], "x")
    return rounded(out.select("user_id", "event_id", "avg3", "avg5", "avg10", "trend"), 8, "avg3", "avg5", "avg10")


FRAUD_SQL = """WITH w AS (SELECT user_id, event_id, value, count(*) OVER o AS n, sum(value) OVER o AS total FROM events
        WINDOW o AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)),
    r AS (SELECT *, 'too many transactions' AS reason FROM w WHERE n > 8 UNION ALL SELECT *, 'high amount' FROM w WHERE total > 600
          UNION ALL SELECT *, 'unusual large transaction' FROM w WHERE value > total / n * 4)
    SELECT user_id, event_id, n AS recent_count, round(total, 4) AS recent_total, reason FROM r"""


@query("fraud_alerts", "I6", FRAUD_SQL)
def _(t):
    e = t("events", "user_id", "event_id", "ts", "value")
    out = K.fraud_alerts(e, "user_id", "ts", "value", 3 * 86400, 8, 600.0, 4.0)
    return rounded(out.select("user_id", "event_id", "recent_count", "recent_total", "reason"), 4, "recent_total")


THRESHOLD_SQL = """WITH w AS (SELECT *, avg(value) OVER a + 2 * stddev_pop(value) OVER a AS th, count(*) OVER a AS n FROM events
        WINDOW a AS (PARTITION BY user_id, event_type ORDER BY ts ROWS 99 PRECEDING)),
    h AS (SELECT *, CASE WHEN n >= 10 THEN th ELSE 80.0 END AS threshold FROM w),
    j AS (SELECT *, CASE WHEN abs(threshold - lag(threshold, 1, 80.0::DOUBLE) OVER (PARTITION BY user_id, event_type ORDER BY ts)) > 5 THEN 1 ELSE 0 END AS moved FROM h),
    k AS (SELECT *, sum(moved) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS adjustments FROM j)
    SELECT user_id, event_type, event_id, value, round(threshold, 7) AS threshold, CAST(adjustments AS BIGINT) AS adjustments,
           CASE WHEN value > threshold * 1.5 THEN 'CRITICAL' WHEN value > threshold * 1.2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM k WHERE value > threshold"""


@query("adaptive_threshold_alerts", "I7", THRESHOLD_SQL)
def _(t):
    e = t("events", "user_id", "event_type", "event_id", "ts", "value")
    out = K.adaptive_threshold(e, ["user_id", "event_type"], "ts", ["ts", "event_id"], "value").where(F.col("severity").isNotNull())
    return rounded(out.select("user_id", "event_type", "event_id", "value", "threshold", "adjustments", "severity"), 7, "threshold")


_BASE = f"""b AS (SELECT *, row_number() OVER w AS n, sum(x) OVER w AS s, sum(x * x) OVER w AS q,
        avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 19 PRECEDING) AS recent FROM {CLICKS} WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    m AS (SELECT *, s / n AS mean, sqrt(greatest(q / n - (s / n) * (s / n), 0)) AS sd FROM b WHERE n >= 10),
    z AS (SELECT *, CASE WHEN sd > 0 THEN abs(x - mean) / sd ELSE 0 END AS zs, CASE WHEN abs(recent - mean) > sd * 0.5 THEN 2.0 ELSE 2.5 END AS lim FROM m),
    c AS (SELECT user_id, event_id, ts, round(zs, 6) AS zscore, CASE WHEN zs > 3.5 THEN 'high' WHEN zs > 2.8 THEN 'medium' ELSE 'low' END AS severity,
          round(least(0.99, (zs - lim) / (4.0 - lim)), 6) AS confidence, round(mean - 2 * sd, 4) AS expected_low, round(mean + 2 * sd, 4) AS expected_high
          FROM z WHERE zs > lim)"""
_BASE_COLUMNS = "user_id", "event_id", "zscore", "severity", "confidence", "expected_low", "expected_high"


def _baseline(out):
    return rounded(rounded(out.select(*_BASE_COLUMNS), 6, "zscore", "confidence"), 4, "expected_low", "expected_high")


@query("baseline_scores", "I10", f"WITH {_BASE} SELECT {', '.join(_BASE_COLUMNS)} FROM c")
def _(t):
    return _baseline(K.baseline_anomalies(clicks(t), "user_id", "ts", ["ts", "event_id"], "x", 0))


@query("baseline_anomalies", "I10", f"""WITH RECURSIVE {_BASE},
    k AS (SELECT user_id, min(ts) AS ts FROM c GROUP BY 1
          UNION ALL SELECT k.user_id, min(c.ts) FROM k JOIN c ON c.user_id = k.user_id AND epoch_us(c.ts) - epoch_us(k.ts) > {72 * HOUR_US} GROUP BY k.user_id)
    SELECT {', '.join(_BASE_COLUMNS)} FROM c JOIN k USING (user_id, ts)""")
def _(t):
    return _baseline(K.baseline_anomalies(clicks(t), "user_id", "ts", ["ts", "event_id"], "x", 72 * 3600))


@query("rate_limited_requests", "I16", f"""WITH RECURSIVE
    k AS (SELECT user_id, min(ts) AS w FROM events GROUP BY 1
          UNION ALL SELECT k.user_id, min(e.ts) FROM k JOIN events e ON e.user_id = k.user_id AND epoch_us(e.ts) - epoch_us(k.w) > {24 * HOUR_US} GROUP BY k.user_id),
    j AS (SELECT k.user_id, event_id, ts, w FROM events ASOF JOIN k ON events.user_id = k.user_id AND events.ts >= k.w),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, w ORDER BY ts) AS c FROM j)
    SELECT user_id, event_id, c <= 3 AS accepted, 3 - c AS remaining FROM r""")
def _(t):
    out = K.rate_limit(t("events", "user_id", "event_id", "ts"), "user_id", "ts", 3, 24 * 3600)
    return out.select("user_id", "event_id", "accepted", "remaining")


@query("session_quality_reports", "I11", f"""WITH
    b AS (SELECT *, row_number() OVER w AS pos, epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER w) // 1000 AS gap, min(ts) OVER w AS began,
        avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 4 PRECEDING) AS r5, avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 9 PRECEDING AND 5 PRECEDING) AS p5,
        avg(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 49 PRECEDING) AS average, stddev_pop(x) OVER (PARTITION BY user_id ORDER BY ts ROWS 49 PRECEDING) AS sd
        FROM {CLICKS} WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, pos - max(CASE WHEN x > 1000 THEN 0 ELSE pos END) OVER w AS slow, pos - max(CASE WHEN x < 500 THEN 0 ELSE pos END) OVER w AS fast
        FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    f AS (SELECT *, max(fast) OVER (PARTITION BY user_id ORDER BY ts) AS best, least(1.0, least(1.0, slow / 10.0::DOUBLE) + CASE WHEN gap > 10000 THEN 0.3::DOUBLE ELSE 0 END
        + CASE WHEN pos >= 10 AND r5 > p5 * 1.3::DOUBLE THEN 0.4::DOUBLE ELSE 0 END) AS fatigue FROM s),
    e AS (SELECT *, greatest(0.0, least(1.0, 1 - fatigue + CASE WHEN pos >= 5 THEN greatest(0.0, 1 - sd / 1000.0) * 0.4::DOUBLE ELSE 0 END + least(0.4::DOUBLE, best / 20.0::DOUBLE))) AS engagement FROM f),
    l AS (SELECT *, CASE WHEN fatigue > 0.7 THEN 'high' WHEN fatigue > 0.4 THEN 'moderate' ELSE 'low' END AS fl,
        CASE WHEN engagement > 0.8 THEN 'high' WHEN engagement > 0.5 THEN 'moderate' ELSE 'low' END AS el FROM e
        WHERE pos % 10 = 0 OR slow >= 5 OR fatigue > 0.7)
    SELECT user_id, event_id, round(engagement * 0.7 + (1 - fatigue) * 0.3, 6) AS overall, round(average, 6) AS average, fl AS fatigue_level, el AS engagement_level,
        epoch_us(ts) // 1000 - epoch_us(began) // 1000 AS duration_ms,
        CASE WHEN fl = 'high' THEN 'Consider taking a break - fatigue detected' WHEN fl = 'moderate' AND el = 'low' THEN 'Performance declining - short break recommended'
             WHEN el = 'high' THEN 'Excellent performance - keep up the great work!' ELSE 'Steady performance - maintain current pace' END AS recommendation FROM l""")
def _(t):
    out = K.session_quality(clicks(t), "user_id", "ts", ["ts", "event_id"], "x")
    return rounded(
        out.select("user_id", "event_id", "overall", "average", "fatigue_level", "engagement_level", "duration_ms", "recommendation"), 6, "overall", "average"
    )


@query("trending_tags", "I12", f"""
    SELECT tag, round(s, 6) AS score FROM (SELECT tag, sum(pow(0.95::DOUBLE, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 3600000000.0)) AS s
    FROM {TAGGED} GROUP BY 1) WHERE s > 0.1 ORDER BY s DESC, tag LIMIT 10""")
def _(t):
    asof = F.lit("2024-01-31").cast("timestamp")
    return rounded(K.trending_decay(tagged(t), "tag", "ts", asof, unit_seconds=3600), 6, "score")


@query("influence_scores", "I13", """
    SELECT user_id, CAST(max_by(floor(value), ts) AS BIGINT) AS followers, count(*) FILTER (event_type = 'click') AS reposts, count(*) FILTER (event_type = 'view') AS mentions,
      round(ln(max_by(floor(value), ts) + 1) * 0.3 + count(*) FILTER (event_type = 'click') * 0.5 + count(*) FILTER (event_type = 'view') * 0.2, 6) AS score
    FROM events GROUP BY 1 HAVING ln(max_by(floor(value), ts) + 1) * 0.3 + count(*) FILTER (event_type = 'click') * 0.5 + count(*) FILTER (event_type = 'view') * 0.2 > 1.0""")
def _(t):
    e = quantity(t, "user_id", "event_type")
    out = K.influence_score(e, "user_id", "ts", "quantity", F.col("event_type") == "click", F.col("event_type") == "view")
    return rounded(out, 6, "score")


@query("volume_anomalies", "I14", f"""
    WITH c AS (SELECT ws AS start, count(*) AS count FROM {slid('events', 7200, 3600)} GROUP BY 1),
    r AS (SELECT *, count(*) OVER w AS n, sum(count) OVER w AS s, sum(count * count) OVER w AS q FROM c
          WINDOW w AS (ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m AS (SELECT *, s / n AS mean, sqrt(greatest((q - s * (s / n)) / (n - 1), 0)) AS sd FROM r WHERE n > 5)
    SELECT start, count, round(mean, 6) AS mean, round(sd, 6) AS std, round(abs(count - mean) / sd, 6) AS zscore FROM m WHERE sd > 0 AND abs(count - mean) / sd > 2""")
def _(t):
    out = K.volume_anomalies(t("events", "ts"), "ts", "2 hours", "1 hour").drop("end")
    return rounded(out, 6, "mean", "std", "zscore")
