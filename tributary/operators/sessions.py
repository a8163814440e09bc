"""Sessions: runs of activity of a user without a long gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.ordered import MEASURE, ROWS_PER_TASK, Cuts, bucket_cuts, collect_in_chunks, with_running

# Purchases stay together while the gap, in whole minutes, is at most 30.
GAP_30_WHOLE_MINUTES = 31 * 60


def label_sessions(
    df: DataFrame, keys: Sequence[str], time: str, limit_seconds: float, rows_per_task: int = ROWS_PER_TASK,
    name: str = "session_start", cuts: Cuts | str = MEASURE,
) -> DataFrame:
    """Add the start time of the session each row belongs to.

    A session ends when the next row comes ``limit_seconds`` or more later.
    Both running maxima are carried over buckets, so a hot key's rows are
    not sorted in one task.
    """
    if cuts == MEASURE:
        cuts = bucket_cuts(df, keys, time, rows_per_task)
    seen = with_running(df, keys, time, [time], {"__prev": ("max", F.col(time))}, cuts, inclusive=False)
    gap = F.unix_micros(time) - F.unix_micros("__prev")
    opens = F.col("__prev").isNull() | (gap >= round(limit_seconds * 1_000_000))
    start = F.when(opens, F.col(time))
    return with_running(seen, keys, time, [time], {name: ("max", start)}, cuts).drop("__prev")


def sessions(
    df: DataFrame, keys: Sequence[str], time: str, limit_seconds: float, aggs: dict[str, Column],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per session: start, end (the last row), and the given aggregates."""
    labelled = label_sessions(df, keys, time, limit_seconds, rows_per_task)
    return (
        labelled.groupBy(*keys, "session_start")
        .agg(F.max(time).alias("session_end"), *[c.alias(n) for n, c in aggs.items()])
    )


def purchase_sessions(df: DataFrame, user: str, time: str, item: str, quantity: str, limit_seconds: float = GAP_30_WHOLE_MINUTES,
                      rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Quantity, distinct items and minutes of each purchase session."""
    out = sessions(df, [user], time, limit_seconds, {"total_quantity": F.sum(quantity), "unique_items": F.count_distinct(item)}, rows_per_task)
    micros = F.unix_micros("session_end") - F.unix_micros("session_start")
    return out.withColumn("duration_minutes", F.floor(micros / 60_000_000))


def purchase_sessions_stream(df: DataFrame, user: str, time: str, item: str, quantity: str, delay: str = "1 hour",
                             limit_seconds: float = GAP_30_WHOLE_MINUTES) -> DataFrame:
    """The same on a stream, emitted once the watermark passes a session's end.

    Predicates must use ``session_start`` / ``session_end`` of this result; a
    filter on the session struct itself would move below the merge.
    """
    gap = f"{round(limit_seconds * 1_000_000) - 1} microseconds"
    out = df.withWatermark(time, delay).groupBy(user, F.session_window(time, gap)).agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.sum(quantity).alias("total_quantity"),
        F.size(F.collect_set(item)).cast("bigint").alias("unique_items"),
    )
    micros = F.unix_micros("session_end") - F.unix_micros("session_start")
    return out.select(user, "session_start", "session_end", "total_quantity", "unique_items", F.floor(micros / 60_000_000).alias("duration_minutes"))


def _seconds_between(start: str, end: str) -> Column:
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000)


def session_actions(df: DataFrame, user: str, time: str, action: str, limit_seconds: float = 10, chunk_size: int = 10_000,
                    rows_per_task: int = ROWS_PER_TASK, order: Sequence[str] = ()) -> DataFrame:
    """Expired sessions with their actions in order and their length in seconds.

    Actions of equal times follow ``order`` and then their own names.  Very
    long action lists continue in further ``chunk`` rows.
    """
    cuts = bucket_cuts(df, [user], time, rows_per_task)
    labelled = label_sessions(df, [user], time, limit_seconds, rows_per_task, cuts=cuts)
    lists = collect_in_chunks(labelled, [user, "session_start"], time, action, [time, *order, action], "actions", chunk_size, rows_per_task, cuts)
    spans = labelled.groupBy(user, "session_start").agg(F.max(time).alias("session_end"))
    joined = lists.join(spans, [user, "session_start"])
    return joined.select(user, "session_start", "chunk", "actions", _seconds_between("session_start", "session_end").alias("seconds"))


def session_summary(df: DataFrame, user: str, time: str, kind: str, limit_seconds: float = 30, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Start, end, length (ms), events and distinct event types per session."""
    out = sessions(df, [user], time, limit_seconds, {"total_events": F.count(F.lit(1)), "unique_types": F.count_distinct(kind)}, rows_per_task)
    return out.withColumn("duration_ms", F.unix_millis("session_end") - F.unix_millis("session_start"))


def session_seconds(df: DataFrame, user: str, time: str, limit_seconds: float = 10, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    out = sessions(df, [user], time, limit_seconds, {}, rows_per_task)
    return out.select(user, "session_start", _seconds_between("session_start", "session_end").alias("seconds"))
