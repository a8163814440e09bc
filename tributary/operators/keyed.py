"""Per-key history computations on tables.

Each has a streaming counterpart in :mod:`tributary.streaming.state`; on a
table they are window expressions over the helpers of
:mod:`tributary.operators.ordered`, which keep hot keys parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tributary.operators.ordered import ROWS_PER_TASK, bucket_cuts, bucket_of, over_last_interval, over_last_rows, with_running
from tributary.session import settled


def user_activity(df: DataFrame, user: str, time: str) -> DataFrame:
    """Actions and last time seen per user; also a streaming aggregate."""
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("actions"), F.max(time).alias("last_seen"))


def count_alert(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).withColumn("alert", F.col("count") > limit)


def running_sums(df: DataFrame, key: str, value: str) -> DataFrame:
    x = F.col(value)
    return df.groupBy(key).agg(F.count(x).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("total_squares"))


def rolling_avg(df: DataFrame, key: str, time: str, order: Sequence[str], value: str, n: int = 3, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Mean of the last ``n`` values of a key, from the n-th row on."""
    out = over_last_rows(df, [key], time, order, n - 1, {"rolling_avg": lambda w: F.avg(value).over(w.rowsBetween(1 - n, 0))}, rows_per_task)
    return out.where(F.col("position") >= n)


def multi_window_trend(df: DataFrame, key: str, time: str, order: Sequence[str], value: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Means of the last 3, 5 and 10 values and their trend."""
    means = {f"avg{n}": (lambda w, n=n: F.avg(value).over(w.rowsBetween(1 - n, 0))) for n in (3, 5, 10)}
    out = over_last_rows(df, [key], time, order, 9, means, rows_per_task).where(F.col("position") >= 10)
    a, b, c = F.col("avg3"), F.col("avg5"), F.col("avg10")
    trend = (
        F.when((a < b) & (b < c), "improving").when((a > b) & (b > c), "degrading")
        .when((F.abs(a - b) < 50) & (F.abs(b - c) < 50), "stable").otherwise("fluctuating")
    )
    return out.withColumn("trend", trend)


def fraud_alerts(
    df: DataFrame, user: str, time: str, amount: str, window_seconds: int = 60, max_count: int = 5,
    max_total: float = 10_000.0, times_average: float = 5.0, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Alerts per transaction over the user's last ``window_seconds``.

    Every row is one step; it can raise up to three alerts: too many
    transactions, a high total, an amount far above the recent mean.
    """
    out = over_last_interval(
        df, [user], time, window_seconds,
        {"recent_count": lambda w: F.count(F.lit(1)).over(w), "recent_total": lambda w: F.sum(amount).over(w)}, rows_per_task,
    )
    reasons = F.array(
        F.when(F.col("recent_count") > max_count, "too many transactions"),
        F.when(F.col("recent_total") > max_total, "high amount"),
        F.when(F.col(amount) > F.col("recent_total") / F.col("recent_count") * times_average, "unusual large transaction"),
    )
    return out.withColumn("reason", F.explode(F.array_compact(reasons)))


def _severity(value: Column, threshold: Column) -> Column:
    return F.when(value > threshold * 1.5, "CRITICAL").when(value > threshold * 1.2, "HIGH").otherwise("MEDIUM")


def adaptive_threshold(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], value: str, start: float = 80.0,
    keep: int = 100, needed: int = 10, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every reading with its threshold; ``severity`` is null when it is not exceeded.

    The threshold is mean + 2 population deviations of the last ``keep``
    readings (this one included) once there are ``needed``, before that ``start``.
    """

    def threshold(w, first: int, last: int) -> Column:
        span = w.rowsBetween(first, last)
        learned = F.avg(value).over(span) + 2 * F.stddev_pop(value).over(span)
        return F.when(F.count(value).over(span) >= needed, learned).otherwise(F.lit(start))

    cuts = bucket_cuts(df, keys, time, rows_per_task)
    out = over_last_rows(
        df, keys, time, order, keep,
        {"threshold": lambda w: threshold(w, 1 - keep, 0), "__before": lambda w: threshold(w, -keep, -1)}, rows_per_task, cuts=cuts,
    )
    moved = (F.abs(F.col("threshold") - F.col("__before")) > 5).cast("bigint")
    counted = with_running(out, keys, time, order, {"adjustments": ("sum", moved)}, cuts)
    alert = F.when(F.col(value) > F.col("threshold"), _severity(F.col(value), F.col("threshold")))
    return counted.withColumn("severity", alert).drop("__before")


def baseline_scores(
    df: DataFrame, key: str, time: str, order: Sequence[str], value: str, needed: int = 10, recent: int = 20,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Readings that leave the key's own baseline (no cool-down yet).

    The baseline is the running mean and deviation including the reading; a
    drift of the last ``recent`` readings lowers the threshold.
    """
    x = F.col(value).cast("double")
    cuts = bucket_cuts(df, [key], time, rows_per_task)
    means = {"__recent": lambda w: F.avg(x).over(w.rowsBetween(1 - recent, 0))}
    last = over_last_rows(df, [key], time, order, recent - 1, means, rows_per_task, cuts=cuts)
    run = with_running(last, [key], time, order, {"__s": ("sum", x), "__q": ("sum", x * x)}, cuts).where(F.col("position") >= needed)
    mean = F.col("__s") / F.col("position")
    sd = F.sqrt(F.greatest(F.col("__q") / F.col("position") - mean * mean, F.lit(0.0)))
    scored = run.withColumns({"mean": mean, "std": sd})
    z = F.when(F.col("std") > 0, F.abs(x - F.col("mean")) / F.col("std")).otherwise(0.0)
    limit = F.when(F.abs(F.col("__recent") - F.col("mean")) > F.col("std") * 0.5, 2.0).otherwise(2.5)
    out = scored.withColumns({"zscore": z, "limit": limit}).where(F.col("zscore") > F.col("limit"))
    return out.withColumns(
        {
            "severity": F.when(F.col("zscore") > 3.5, "high").when(F.col("zscore") > 2.8, "medium").otherwise("low"),
            "confidence": F.least(F.lit(0.99), (F.col("zscore") - F.col("limit")) / (4.0 - F.col("limit"))),
            "expected_low": F.col("mean") - 2 * F.col("std"), "expected_high": F.col("mean") + 2 * F.col("std"),
        }
    ).drop("__recent", "__s", "__q")


def _windows(us: np.ndarray, apart_us: int, anchor: int | None, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(first of its window, place in it) of sorted times, one turn a window; ``anchor`` opened the window that is open before them."""
    first, counts, at = np.zeros(len(us), dtype=bool), np.empty(len(us), dtype=np.int64), 0
    while at < len(us):
        if anchor is None or us[at] - anchor > apart_us:
            anchor, count, first[at] = int(us[at]), 0, True
        end = int(np.searchsorted(us, anchor + apart_us, side="right"))
        counts[at:end] = np.arange(count + 1, count + 1 + end - at)
        count, at = count + end - at, end
    return first, counts


def _greedy(key: str, time_us: str, apart_us: int, keep_first_after: bool):
    """Sequential pass over rows sorted by (key, time), one key of a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, anchor, count = None, None, 0
        for pdf in batches:
            keys, us = pdf[key].to_numpy(), pdf[time_us].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            keep, counts = np.zeros(len(us), dtype=bool), np.zeros(len(us), dtype=np.int64)
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != current:
                    current, anchor, count = keys[a], None, 0
                first, counts[a:b] = _windows(us[a:b], apart_us, anchor, count)
                keep[a:b] = first | (not keep_first_after)
                opened = np.flatnonzero(first)
                anchor, count = int(us[a + opened[-1]]) if len(opened) else anchor, int(counts[b - 1])
            yield pdf.assign(__keep=keep, __count=counts)

    return run


def _bucket_function(us: np.ndarray, apart_us: int) -> pd.DataFrame:
    """What a bucket does to the window that is open before it.

    Whichever of its times opens the bucket's first own window, it leads to one
    last window: (``us``, ``exit_us`` that opens the last one, ``exit_n`` rows of
    it).  Only times that a window from before can leave to are listed.
    """
    u, rows = np.unique(us, return_counts=True)
    after = np.searchsorted(u, u + apart_us, side="right")  # the time that opens the next window
    last = np.arange(len(u))
    step = np.where(after < len(u), after, last)
    while (step[step] != step).any():  # pointer doubling: each turn looks twice as far ahead
        step = step[step]
    reach = int(np.searchsorted(u, u[0] + apart_us, side="right")) + 1
    left = np.concatenate([np.cumsum(rows[::-1])[::-1], [0]])
    out = step[:reach]
    return pd.DataFrame({"us": u[:reach], "exit_us": u[out], "exit_n": left[out], "total": len(us)})


def _in_buckets(rows: DataFrame, apart_us: int, keep_first_after: bool, schema: StructType, order: Sequence[str]) -> DataFrame:
    """The rule over rows (``__id``, ``__b``, ``__us``): buckets are summarised in parallel, composed in order, and walked in parallel."""

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _bucket_function(pdf["__us"].to_numpy(), apart_us).assign(__id=key[0], __b=key[1])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        anchor, count, out = None, 0, []
        for b, part in pdf.sort_values(["__b", "us"]).groupby("__b", sort=True):
            out.append((part["__id"].iloc[0], b, -1 if anchor is None else anchor, anchor is not None, count))
            us = part["us"].to_numpy()
            i = 0 if anchor is None else int(np.searchsorted(us, anchor + apart_us, side="right"))
            if i < len(us):
                anchor, count = int(part["exit_us"].iloc[i]), int(part["exit_n"].iloc[i])
            else:
                count += int(part["total"].iloc[0])
        return pd.DataFrame(out, columns=["__id", "__b", "__anchor", "__open", "__before"])

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__us", *order], kind="stable")
        opened = pdf["__open"].iloc[0]
        first, counts = _windows(pdf["__us"].to_numpy(), apart_us, int(pdf["__anchor"].iloc[0]) if opened else None, int(pdf["__before"].iloc[0]))
        return pdf.assign(__keep=first | (not keep_first_after), __count=counts)[[f.name for f in schema.fields]]

    stored = settled(rows)
    functions = stored.select("__id", "__b", "__us").groupBy("__id", "__b").applyInPandas(summarise, "us long, exit_us long, exit_n long, total long, __id string, __b long")
    entries = functions.groupBy("__id").applyInPandas(compose, "__id string, __b long, __anchor long, __open boolean, __before long")
    return stored.join(settled(entries), ["__id", "__b"]).groupBy("__id", "__b").applyInPandas(walk, schema)


def _in_islands(df: DataFrame, key: str, time: str, gap_us: int, rows_per_task: int) -> DataFrame:
    """Split a key where nothing can carry over: a pause longer than ``gap_us``."""
    from tributary.operators.sessions import label_sessions

    return label_sessions(df, [key], time, (gap_us + 1) / 1_000_000, rows_per_task, "__island")


def _sequential(df: DataFrame, key: str, time: str, gap_us: int, keep_first_after: bool, rows_per_task: int, order: Sequence[str] = ()) -> DataFrame:
    # rows without a time have no island, so as equal times they are one window of their own
    split = _in_islands(df, key, time, gap_us, rows_per_task).withColumns(
        {"__us": F.coalesce(F.unix_micros(time), F.lit(0)), "__id": F.concat_ws("|", F.col(key).cast("string"), F.unix_micros("__island"))}
    )
    schema = StructType([*split.schema.fields, StructField("__keep", BooleanType()), StructField("__count", LongType())])
    cuts = bucket_cuts(split, ["__id"], "__us", rows_per_task)
    if cuts is None:
        placed = split.repartition(key, "__island").sortWithinPartitions("__id", "__us", *order)
        out = placed.mapInPandas(_greedy("__id", "__us", gap_us, keep_first_after), schema)
    else:
        out = _in_buckets(split.withColumn("__b", bucket_of(F.col("__us"), cuts)), gap_us, keep_first_after, schema, order)
    return out.drop("__us", "__id", "__island")


def baseline_anomalies(
    df: DataFrame, key: str, time: str, order: Sequence[str], value: str, cooldown_seconds: float = 5.0,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """:func:`baseline_scores` with a pause of more than the cool-down between alerts of a key.

    The pause depends on the alert before, a sequential rule.  It only sees the
    few candidates, split wherever a pause already separates them.
    """
    found = baseline_scores(df, key, time, order, value, rows_per_task=rows_per_task)
    if cooldown_seconds <= 0:
        return found
    kept = _sequential(found, key, time, int(cooldown_seconds * 1_000_000), True, rows_per_task, order)
    return kept.where("__keep").drop("__keep", "__count")


def rate_limit(df: DataFrame, key: str, time: str, limit: int = 100, window_seconds: int = 60, rows_per_task: int = ROWS_PER_TASK,
               order: Sequence[str] = ()) -> DataFrame:
    """Accept the first ``limit`` requests of a key per window.

    A window opens with a request and the first one more than
    ``window_seconds`` later opens the next.  Where requests pause that long
    the rows are split.  Unbroken activity of more than ``rows_per_task`` rows
    is cut into buckets: what a bucket does to an open window is a small
    function of where that window ends, and functions compose, so buckets are
    walked in parallel.  ``order`` decides among equal times.
    """
    out = _sequential(df, key, time, window_seconds * 1_000_000, False, rows_per_task, order)
    return out.withColumns(
        {"accepted": F.col("__count") <= limit, "remaining": F.lit(limit) - F.col("__count")}
    ).drop("__keep", "__count")


def session_quality(df: DataFrame, key: str, time: str, order: Sequence[str], value: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Engagement and fatigue of a click series; only the reported rows.

    Slow is above 1000 ms, fast below 500 ms.  A row is reported every tenth
    click, from five slow clicks in a row, or when fatigue exceeds 0.7.
    """
    x = F.col(value).cast("double")
    hist = 50

    def mean(first: int, last: int):
        return lambda w: F.avg(x).over(w.rowsBetween(first, last))

    cuts = bucket_cuts(df, [key], time, rows_per_task)
    out = over_last_rows(
        df, [key], time, order, hist - 1,
        {
            "__gap": lambda w: F.unix_millis(time) - F.unix_millis(F.lag(time).over(w)),
            "__recent": mean(-4, 0), "__earlier": mean(-9, -5), "average": mean(1 - hist, 0),
            "__sd": lambda w: F.stddev_pop(x).over(w.rowsBetween(1 - hist, 0)),
        },
        rows_per_task, cuts=cuts,
    )
    pos = F.col("position")
    broken = with_running(
        out, [key], time, order,
        {"__not_slow": ("max", F.when(x > 1000, 0).otherwise(pos)), "__not_fast": ("max", F.when(x < 500, 0).otherwise(pos)),
         "__start": ("min", F.col(time))}, cuts,
    ).withColumns({"__slow": pos - F.col("__not_slow"), "__fast": pos - F.col("__not_fast")})
    best = with_running(broken, [key], time, order, {"__best": ("max", F.col("__fast"))}, cuts)

    one, zero = F.lit(1.0), F.lit(0.0)
    slow = F.least(one, F.col("__slow") / 10.0)
    pause = F.when(F.col("__gap") > 10000, 0.3).otherwise(0.0)
    worse = F.when((pos >= 10) & (F.col("__recent") > F.col("__earlier") * 1.3), 0.4).otherwise(0.0)
    fatigue = F.least(one, slow + pause + worse)
    steady = F.when(pos >= 5, F.greatest(zero, 1 - F.col("__sd") / 1000.0) * 0.4).otherwise(0.0)
    scored = best.withColumn("fatigue", fatigue).withColumn(
        "engagement", F.greatest(zero, F.least(one, 1 - F.col("fatigue") + steady + F.least(F.lit(0.4), F.col("__best") / 20.0)))
    )
    reported = scored.where((pos % 10 == 0) | (F.col("__slow") >= 5) | (F.col("fatigue") > 0.7))
    tired, keen = F.col("fatigue_level"), F.col("engagement_level")
    return (
        reported.withColumns(
            {
                "overall": F.col("engagement") * 0.7 + (1 - F.col("fatigue")) * 0.3,
                "fatigue_level": F.when(F.col("fatigue") > 0.7, "high").when(F.col("fatigue") > 0.4, "moderate").otherwise("low"),
                "engagement_level": F.when(F.col("engagement") > 0.8, "high").when(F.col("engagement") > 0.5, "moderate").otherwise("low"),
                "duration_ms": F.unix_millis(time) - F.unix_millis("__start"),
            }
        )
        .withColumn(
            "recommendation",
            F.when(tired == "high", ADVICE["rest"]).when((tired == "moderate") & (keen == "low"), ADVICE["pause"])
            .when(keen == "high", ADVICE["praise"]).otherwise(ADVICE["go on"]),
        )
        .drop("__gap", "__recent", "__earlier", "__sd", "__not_slow", "__not_fast", "__slow", "__fast", "__best", "__start")
    )


# The four recommendation texts.
ADVICE = {
    "rest": "Consider taking a break - fatigue detected",
    "pause": "Performance declining - short break recommended",
    "praise": "Excellent performance - keep up the great work!",
    "go on": "Steady performance - maintain current pace",
}


def trending_decay(df: DataFrame, tag: str, time: str, asof: Column, decay: float = 0.95, unit_seconds: float = 1.0,
                   floor: float = 0.1, k: int = 10) -> DataFrame:
    """Top tags by mentions weighted ``decay`` per time unit of age at ``asof``."""
    age = (F.unix_micros(asof) - F.unix_micros(time)) / (1_000_000.0 * unit_seconds)
    scores = df.groupBy(tag).agg(F.sum(F.pow(F.lit(decay), age)).alias("score")).where(F.col("score") > floor)
    return scores.orderBy(F.desc("score"), tag).limit(k)


def influence_score(df: DataFrame, user: str, time: str, followers: str, is_repost: Column, mentions: Column, at_least: float = 1.0) -> DataFrame:
    """0.3 ln(followers + 1) + 0.5 reposts + 0.2 mentions, highest first."""
    per_user = df.groupBy(user).agg(
        F.max_by(followers, F.struct(time, followers)).alias("followers"), F.sum(is_repost.cast("bigint")).alias("reposts"),
        F.sum(mentions.cast("bigint")).alias("mentions"),
    )
    score = F.log(F.col("followers") + 1) * 0.3 + F.col("reposts") * 0.5 + F.col("mentions") * 0.2
    return per_user.withColumn("score", score).where(F.col("score") > at_least).orderBy(F.desc("score"), user)


def volume_anomalies(df: DataFrame, time: str, size: str = "60 seconds", slide: str = "30 seconds", needed: int = 5, z: float = 2.0) -> DataFrame:
    """Windows whose row count is far from all windows before.

    The running sums over windows are carried across time buckets, so the
    series is not squeezed through one task.
    """
    from tributary.functions.intervals import seconds
    from tributary.operators.windows import sliding

    counts = sliding(df, time, size, slide, {"count": ("count", "*")})
    n = F.col("count").cast("double")
    width = max(seconds(size), seconds(slide)) * 1_000_000 * 100_000
    run = with_running(
        counts, [], "start", ["start"], {"__n": ("sum", F.lit(1)), "__s": ("sum", n), "__q": ("sum", n * n)}, width, inclusive=False
    ).where(F.col("__n") > needed)
    mean = F.col("__s") / F.col("__n")
    sd = F.sqrt(F.greatest((F.col("__q") - F.col("__s") * mean) / (F.col("__n") - 1), F.lit(0.0)))
    out = run.withColumns({"mean": mean, "std": sd})
    score = F.when(F.col("std") > 0, F.abs(n - F.col("mean")) / F.col("std")).otherwise(0.0)
    return out.withColumn("zscore", score).where(F.col("zscore") > z).select("start", "end", "count", "mean", "std", "zscore")

