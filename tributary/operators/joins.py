"""Joins of tables and streams.

Equi-joins carry no broadcast hint: Catalyst broadcasts a side whose size it
knows to be small and otherwise sort-merges, with adaptive execution splitting
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.intervals import floor_div
from tributary.operators.ordered import ROWS_PER_TASK, SMALL_INPUT_BYTES, collect_in_chunks
from tributary.session import plainly_small, settled


def join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equi-join of differently named keys, any join type."""
    return left.join(right, F.col(left_key) == F.col(right_key), how)


def lookup_with_default(df: DataFrame, names: DataFrame, key: str, names_key: str, name: str, default: str = "Unknown") -> DataFrame:
    """Add ``name`` from a lookup table; rows without a match get the default."""
    side = names.select(F.col(names_key).alias("__key"), F.col(name).alias("__name"))
    return df.join(side, F.col(key) == F.col("__key"), "left").withColumn(name, F.coalesce("__name", F.lit(default))).drop("__key", "__name")


def interval_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
    lo: int, hi: int, how: str = "inner", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Pairs with equal keys and right time in [left time + lo, left time + hi] seconds.

    ``how`` is ``inner`` or ``left``.  On streams (give both a watermark) this
    is Spark's range-bounded join.  On tables time is cut into buckets as long
    as the interval and the join runs on (key, bucket): a hot key is spread
    over its buckets and only neighbours in time are compared.  A bucket with
    more than ``rows_per_task`` left rows of one key, a burst, is cut further,
    at quantiles of their times, and right rows go to the parts they reach.
    """
    lt, rt = F.unix_micros(left_time), F.unix_micros(right_time)
    keys = F.col(left_key) == F.col(right_key)
    if left.isStreaming or right.isStreaming:
        within = F.col(right_time).between(
            F.col(left_time) + F.expr(f"INTERVAL '{lo}' SECOND"), F.col(left_time) + F.expr(f"INTERVAL '{hi}' SECOND")
        )
        return left.join(right, keys & within, {"inner": "inner", "left": "leftOuter"}[how])
    width = max(1, hi - lo) * 1_000_000
    # every left time whose interval covers this right time lies in [rt - hi, rt - lo]
    low, high = rt - hi * 1_000_000, rt - lo * 1_000_000
    placed = left.withColumn("__lb", floor_div(lt, width))
    spread = right.withColumn("__rb", F.explode(F.sequence(floor_div(low, width), floor_div(high, width))))
    within = (rt - lt).between(lo * 1_000_000, hi * 1_000_000)
    on = keys & (F.col("__lb") == F.col("__rb"))
    bursts = _bursts(placed, left_key, lt, rows_per_task)
    if bursts is not None:
        part = lambda at: F.size(F.filter("__cuts", lambda c: c <= at))
        cuts = bursts.select(F.col(left_key).alias("__k"), F.col("__lb").alias("__b"), "__cuts")
        whole = F.coalesce("__cuts", F.array().cast("array<bigint>"))
        placed = placed.join(cuts, (F.col(left_key) == F.col("__k")) & (F.col("__lb") == F.col("__b")), "left").withColumn("__cuts", whole)
        placed = placed.withColumn("__lp", part(lt)).drop("__k", "__b", "__cuts")
        spread = spread.join(cuts, (F.col(right_key) == F.col("__k")) & (F.col("__rb") == F.col("__b")), "left").withColumn("__cuts", whole)
        spread = spread.withColumn("__rp", F.explode(F.sequence(part(low), part(high)))).drop("__k", "__b", "__cuts")
        on &= F.col("__lp") == F.col("__rp")
    joined = placed.join(spread, on & within, how)
    return joined.drop("__lb", "__rb", "__lp", "__rp")


def _bursts(placed: DataFrame, key: str, at: Column, rows_per_task: int) -> DataFrame | None:
    """(key, __lb, __cuts): quantiles of the times of every (key, bucket) with too many rows, or None if there is none.

    One aggregation, combined before the shuffle, finds them; a second reads
    their rows alone.  There is at most one cut per ``rows_per_task`` rows.
    """
    if rows_per_task >= ROWS_PER_TASK and plainly_small(placed, SMALL_INPUT_BYTES):
        return None
    cells = placed.where(F.col(key).isNotNull()).groupBy(key, "__lb").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_task)
    cells = settled(cells)
    most = cells.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    parts = -(-most // rows_per_task)
    shares = [i / parts for i in range(1, parts)]
    rows = placed.select(key, "__lb", at.alias("__at")).join(cells.select(key, "__lb"), [key, "__lb"], "left_semi")
    cuts = rows.groupBy(key, "__lb").agg(F.array_sort(F.array_distinct(F.percentile_approx("__at", shares, max(10_000, 20 * parts)))).alias("__cuts"))
    return settled(cuts)


def enrich_left_outer(actions: DataFrame, profiles: DataFrame, key: str, profile_key: str, action_time: str, profile_time: str, within: int = 3600) -> DataFrame:
    """Actions with the profile updates of the hour before; null when there are none.

    The time bound lets a stream drop old state.
    """
    return interval_join(actions, profiles, key, profile_key, action_time, profile_time, -within, 0, "left")


def cogroup_lists(
    left: DataFrame, right: DataFrame, key: str, time: str, left_value: str, right_value: str, order: Sequence[str],
    chunk_size: int = 10_000, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Both sides' values per key, an empty list when a side has none.

    Long lists continue in further chunks of the same key, see
    :func:`collect_in_chunks`.
    """
    a = collect_in_chunks(left, [key], time, left_value, order, "left_items", chunk_size, rows_per_task)
    b = collect_in_chunks(right, [key], time, right_value, order, "right_items", chunk_size, rows_per_task)
    both = a.join(b, [key, "chunk"], "full")
    return both.withColumns(
        {
            "left_items": F.coalesce("left_items", F.array().cast(a.schema["left_items"].dataType)),
            "right_items": F.coalesce("right_items", F.array().cast(b.schema["right_items"].dataType)),
        }
    )


def join_back(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Each row with aggregates of its own group.

    The aggregates are computed first and joined back, so a hot group's rows
    never meet in one task, and are not shuffled when the groups are few.
    """
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    if not df.isStreaming and not plainly_small(df, SMALL_INPUT_BYTES):
        per_group = settled(per_group)
    return df.join(per_group, list(keys))


def stream_join_support(left: DataFrame, right: DataFrame, key: str) -> dict[str, bool]:
    """Which join types Spark accepts for these two sides (a static or streaming each).

    Asked of the analyzer's streaming check, nothing runs.
    """
    out = {}
    for how in ("inner", "left_outer", "right_outer", "full_outer", "left_semi", "left_anti"):
        joined = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), how)
        try:
            checker = joined.sparkSession._jvm.org.apache.spark.sql.catalyst.analysis.UnsupportedOperationChecker
            mode = joined.sparkSession._jvm.org.apache.spark.sql.catalyst.streaming.InternalOutputModes
            checker.checkForStreaming(joined._jdf.queryExecution().analyzed(), getattr(mode, "Append$").__getattr__("MODULE$"))
            out[how] = True
        except Exception:
            out[how] = False
    return out
