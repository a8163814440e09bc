"""Time windows: tumbling, sliding, and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.intervals import floor_div, seconds
from tributary.operators.ordered import ROWS_PER_TASK, SMALL_INPUT_BYTES, bucket_cuts, with_running
from tributary.session import plainly_small, settled

# name -> (function, column); functions: count, sum, min, max, avg
Aggs = dict[str, tuple[str, str | Column]]
_PLAIN = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}


def _as_column(c: str | Column) -> Column:
    return F.lit(1) if isinstance(c, str) and c == "*" else F.col(c) if isinstance(c, str) else c


def tumbling(df: DataFrame, time: str, size: str, aggs: Aggs, keys: Sequence[str] = ()) -> DataFrame:
    out = df.groupBy(*keys, F.window(time, size)).agg(*[_PLAIN[k](_as_column(c)).alias(n) for n, (k, c) in aggs.items()])
    return out.select("window.start", "window.end", *keys, *aggs)


def sliding(df: DataFrame, time: str, size: str, slide: str, aggs: Aggs, keys: Sequence[str] = ()) -> DataFrame:
    """Overlapping windows.

    A table is first reduced to panes as long as the slide; each window adds up
    its panes.  So every row is counted once, not ``size / slide`` times, and
    only panes are shuffled.  A stream uses Spark's own sliding window.
    """
    width, step = seconds(size), seconds(slide)
    if df.isStreaming or width % step:
        out = df.groupBy(*keys, F.window(time, size, slide)).agg(*[_PLAIN[k](_as_column(c)).alias(n) for n, (k, c) in aggs.items()])
        return out.select("window.start", "window.end", *keys, *aggs)
    partial: list[Column] = []
    final: list[Column] = []
    for name, (kind, c) in aggs.items():
        column = _as_column(c)
        if kind == "avg":
            partial += [F.sum(column).alias(f"__s_{name}"), F.count(column).alias(f"__n_{name}")]
            final.append(F.try_divide(F.sum(f"__s_{name}"), F.sum(f"__n_{name}")).alias(name))
        else:
            partial.append(_PLAIN[kind](column).alias(f"__{name}"))
            merge = F.sum if kind in ("count", "sum") else _PLAIN[kind]
            final.append(merge(f"__{name}").alias(name))
    pane = floor_div(F.unix_seconds(time), step) * step
    panes = df.groupBy(*keys, pane.alias("__pane")).agg(*partial)
    starts = F.sequence(F.col("__pane") - (width - step), F.col("__pane"), F.lit(step).cast("bigint"))
    merged = panes.withColumn("__start", F.explode(starts)).groupBy(*keys, "__start").agg(*final)
    return merged.select(
        F.timestamp_seconds("__start").alias("start"), F.timestamp_seconds(F.col("__start") + width).alias("end"), *keys, *aggs
    )


def rows_in_window(df: DataFrame, time: str, size: str, slide: str | None = None) -> DataFrame:
    """Each row with every window it falls in."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    rest = df.columns
    return df.withColumn("window", w).select("window.start", "window.end", *rest)


def throughput(df: DataFrame, time: str, text: str, size: str = "10 seconds") -> DataFrame:
    """Records, bytes and rates per window."""
    per = float(seconds(size))
    out = tumbling(df, time, size, {"total_records": ("count", "*"), "__bytes": ("sum", F.length(text)), "avg_record_size": ("avg", F.length(text))})
    return out.select(
        "start", "end", "total_records", (F.col("total_records") / per).alias("records_per_second"),
        (F.col("__bytes") / per).alias("bytes_per_second"), "avg_record_size",
        (F.col("__bytes") / (1024 * 1024)).alias("megabytes"),
    )


def lag_monitor(df: DataFrame, arrival: str, lag: str, size: str = "30 seconds") -> DataFrame:
    from tributary.operators.aggregates import with_percentiles

    aggs = {"count": "rows", "avg_lag": "avg", "min_lag": "min", "max_lag": "max"}
    out = with_percentiles(df, lag, [F.window(arrival, size).alias("window")], {"p95_lag": 0.95}, aggs)
    return out.select("window.start", "window.end", "count", "avg_lag", "min_lag", "max_lag", "p95_lag")


def zscore_windows(
    df: DataFrame, time: str, value: str, size: str = "20 seconds", expected_avg: float = 50.0,
    expected_std: float = 10.0, expected_count: int = 100,
) -> DataFrame:
    """Window statistics and whether they leave the expected ranges."""
    out = df.groupBy(F.window(time, size)).agg(
        F.count(value).alias("count"), F.avg(value).alias("average"), F.stddev(value).alias("std"),
        F.min(value).alias("minimum"), F.max(value).alias("maximum"),
    )
    z = F.abs(F.col("average") - expected_avg) / expected_std if expected_std > 0 else F.lit(0.0)
    off = F.abs(F.col("count") - expected_count) / expected_count
    rule = (z > 2.0) | (off > 0.5) | (F.coalesce("std", F.lit(0.0)) > expected_std * 2)
    return out.select("window.start", "window.end", "count", "average", "std", "minimum", "maximum", rule.alias("anomaly"))


# Records per millisecond above which a trigger interval is advised.
INTERVALS = [(1.0, "5 seconds"), (0.5, "10 seconds"), (0.1, "20 seconds")]
SLOWEST_INTERVAL = "30 seconds"


def recommend_interval(df: DataFrame, arrival: str, clock_ms: str, size: str = "30 seconds") -> DataFrame:
    """Advised trigger interval from records per busy millisecond of a window."""
    out = df.groupBy(F.window(arrival, size)).agg(
        F.count(F.lit(1)).alias("count"), (F.max(clock_ms) - F.min(clock_ms)).alias("duration_ms")
    )
    rate = F.col("count") / (F.col("duration_ms") + 1)
    advice = None
    for bound, text in INTERVALS:
        advice = F.when(rate > bound, text) if advice is None else advice.when(rate > bound, text)
    return out.select("window.start", "window.end", "count", "duration_ms", rate.alias("records_per_ms"),
                      advice.otherwise(SLOWEST_INTERVAL).alias("interval"))


# p95 latency (ms) above which a watermark delay is advised.
DELAYS = [(10000, "30 seconds"), (5000, "15 seconds")]
SHORTEST_DELAY, MIN_RECORDS = "5 seconds", 10


def recommend_watermark(df: DataFrame, latency_ms: str, keys: Sequence[str] = ()) -> DataFrame:
    """Latency statistics and the watermark delay they call for."""
    from tributary.operators.aggregates import value_stats

    advice = F.when(F.col("count") < MIN_RECORDS, SHORTEST_DELAY)
    for bound, text in DELAYS:
        advice = advice.when(F.col("percentile") > bound, text)
    return value_stats(df, latency_ms, keys).withColumn("watermark", advice.otherwise(SHORTEST_DELAY))


# Batch size above which a window length is used.
VELOCITY = [(100, "30 seconds"), (50, "1 minute"), (10, "5 minutes")]
SLOWEST_WINDOW = "15 minutes"


def window_for_velocity(rows: int) -> str:
    return next((size for bound, size in VELOCITY if rows > bound), SLOWEST_WINDOW)


def adaptive_windows(batch: DataFrame, time: str, quantity: str, rows: int | None = None) -> DataFrame:
    """Totals of one micro-batch, the window picked by its size."""
    rows = batch.count() if rows is None else rows
    size = window_for_velocity(rows)
    out = tumbling(batch, time, size, {"total": ("sum", quantity), "count": ("count", "*"), "average": ("avg", quantity)})
    return out.withColumns({"window_size": F.lit(size), "velocity": F.lit(rows).cast("bigint")})


def count_anomalies(df: DataFrame, time: str, key: str, size: str = "30 seconds", factor: float = 2.0) -> DataFrame:
    """Keys counted more than ``factor`` times the mean count of all keys of the window.

    The mean is a second aggregation joined back; on a stream this runs in
    append mode when ``time`` has a watermark.
    """
    counts = df.groupBy(F.window(time, size), key).agg(F.count(F.lit(1)).alias("count"))
    means = counts.groupBy("window").agg(F.avg("count").alias("avg_count"))
    return counts.join(means, "window").where(F.col("count") > F.col("avg_count") * factor).select(
        "window.start", "window.end", key, "count", "avg_count"
    )


def sensor_outliers(df: DataFrame, sensor: str, time: str, value: str, size: str = "5 minutes", slot: str = "30 seconds", sigmas: float = 3.0) -> DataFrame:
    """Values far from the sensor's mean over the window ending with their slot.

    Rows are reduced to (sensor, slot) sums; a window adds up its slots, and
    the few slot rows are joined back to the values.
    """
    step, width = seconds(slot), seconds(size)
    slotted = df.withColumn("__slot", floor_div(F.unix_seconds(time), step) * step)
    x = F.col(value)
    sums = slotted.groupBy(sensor, "__slot").agg(F.count(x).alias("__n"), F.sum(x).alias("__s"), F.sum(x * x).alias("__q"))
    span = Window.partitionBy(sensor).orderBy("__slot").rangeBetween(-(width - step), 0)
    n, s, q = (F.sum(c).over(span) for c in ("__n", "__s", "__q"))
    stats = sums.select(sensor, "__slot", n.alias("samples"), (s / n).alias("mean"), F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))).alias("std"))
    if not plainly_small(df, SMALL_INPUT_BYTES):
        stats = settled(stats)
    far = (F.col("samples") > 1) & (F.abs(x - F.col("mean")) > sigmas * F.col("std"))
    return slotted.join(stats, [sensor, "__slot"]).where(far).drop("__slot")


def sustained_load(
    df: DataFrame, server: str, time: str, load: str, size: str = "2 minutes", slide: str = "30 seconds", limit: float = 0.8, streak: int = 3,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Servers whose window mean stays above the limit for ``streak`` windows in a row.

    A window at or below the limit, or without data, ends the run.  A run is
    known by its first window, one whose predecessor is not high: an equi-join
    finds those, and the latest one so far is a running maximum, carried from
    bucket to bucket, so the windows of one server need not be in one task.
    """
    step = seconds(slide)
    means = sliding(df, time, size, slide, {"avg_load": ("avg", load)}, [server])
    high = means.where(F.col("avg_load") > limit).withColumn("__no", floor_div(F.unix_seconds("start"), step))
    if not plainly_small(df, SMALL_INPUT_BYTES) or rows_per_task < ROWS_PER_TASK:
        high = settled(high)
    before = high.select(F.col(server).alias("__s"), (F.col("__no") + 1).alias("__next"))
    linked = high.join(before, F.col(server).eqNullSafe(F.col("__s")) & (F.col("__no") == F.col("__next")), "left")
    opened = linked.withColumn("__first", F.when(F.col("__next").isNull(), F.col("__no"))).drop("__s", "__next")
    cuts = bucket_cuts(opened, [server], "start", rows_per_task)
    runs = with_running(opened, [server], "start", ["start"], {"__begin": ("max", F.col("__first"))}, cuts)
    counted = runs.withColumn("streak", F.col("__no") - F.col("__begin") + 1)
    return counted.where(F.col("streak") >= streak).select("start", "end", server, "avg_load", "streak")


def adaptive_windows_by_batch(
    df: DataFrame, batch: str, time: str, quantity: str, rules: Sequence[tuple[int, int]] = (), slowest: int = 900
) -> DataFrame:
    """:func:`adaptive_windows` for rows that carry their batch number.

    Every batch gets the window length (seconds) its own size calls for.
    """
    rules = rules or [(bound, seconds(size)) for bound, size in VELOCITY]
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("velocity"))
    if not plainly_small(df, SMALL_INPUT_BYTES):
        sizes = settled(sizes)
    pick = None
    for bound, size in rules:
        rule = F.col("velocity") > bound
        pick = F.when(rule, F.lit(size)) if pick is None else pick.when(rule, F.lit(size))
    sized = df.join(sizes.withColumn("window_seconds", pick.otherwise(F.lit(slowest))), batch)
    opened = F.timestamp_seconds(F.floor(F.unix_seconds(time) / F.col("window_seconds")) * F.col("window_seconds"))
    return sized.groupBy(batch, opened.alias("start"), "window_seconds", "velocity").agg(
        F.sum(quantity).alias("total"), F.count(F.lit(1)).alias("count")
    )
