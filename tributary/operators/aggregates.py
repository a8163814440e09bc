"""Aggregations.  Each works on a static table or a stream unless noted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.intervals import seconds
from tributary.operators.ordered import ROWS_PER_TASK, bucket_cuts, with_running
from tributary.session import settled


def count_all(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def aggregate_with(df: DataFrame, column: str, fn: Callable[[Column], Column], name: str = "agg_so_far") -> DataFrame:
    """Any aggregate function over one column."""
    return df.agg(fn(F.col(column)).alias(name))


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def avg_of(df: DataFrame, column: str, name: str = "average") -> DataFrame:
    return df.agg(F.avg(column).alias(name))


def avg_and_count_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average and row count per key; rows with a null key or value do not count."""
    return df.dropna(subset=[key, value]).groupBy(key).agg(F.avg(value).alias("average"), F.count(F.lit(1)).alias("count"))


def reduce_by_key(df: DataFrame, keys: Sequence[str], value: str, fn: Callable[[Column], Column] = F.sum, name: str = "reduced") -> DataFrame:
    """Associative reduction per key; partial results are combined before the shuffle."""
    return df.groupBy(*keys).agg(fn(F.col(value)).alias(name))


def distinct_count(df: DataFrame, column: str, keys: Sequence[str] = (), exact: bool | None = None, name: str = "distinct") -> DataFrame:
    """Number of distinct values: exact on tables, approximate on streams.

    Streams do not allow an exact distinct aggregate; the sketch keeps the
    state small.  ``exact=True`` on a stream collects the set instead.
    """
    if exact is None:
        exact = not df.isStreaming
    if not exact:
        how = F.approx_count_distinct(column, 0.01)
    elif df.isStreaming:
        how = F.size(F.collect_set(column)).cast("bigint")
    else:
        how = F.count_distinct(column)
    return df.groupBy(*keys).agg(how.alias(name))


def ratio_of_sums(df: DataFrame, key: str, top: str, bottom: str, name: str = "ratio") -> DataFrame:
    return df.groupBy(key).agg((F.sum(top) / F.sum(bottom)).alias(name))


# name -> kind, of one value column; kinds: rows (nulls too), count, avg, min, max
ValueAggs = dict[str, str]


def with_percentiles(df: DataFrame, value: str, keys: Sequence[str | Column], shares: dict[str, float], aggs: ValueAggs, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Aggregates and percentiles per key: the smallest value that ``share`` of the values do not exceed.

    A table's percentiles are exact: equal values are counted, and all results
    follow from the counts, which are summed up in order of the values.  Groups
    that fit a task are shuffled once, to their key; larger ones are counted
    first and cut at quantiles of the value.  A stream's percentiles come from
    a mergeable sketch, exact up to 10,000 values.
    """
    if df.isStreaming:
        how = {"rows": F.count(F.lit(1)), "count": F.count(value), "avg": F.avg(value), "min": F.min(value), "max": F.max(value)}
        ranks = F.percentile_approx(value, list(shares.values()), 10_000)
        out = df.groupBy(*keys).agg(*[how[k].alias(n) for n, k in aggs.items()], ranks.alias("__p"))
        return out.withColumns({n: F.col("__p")[i] for i, n in enumerate(shares)}).drop("__p")
    names = df.select(*keys).columns
    rows = df.select(*keys, F.col(value).alias("__v"))
    cuts = bucket_cuts(rows.where(F.col("__v").isNotNull()), names, "__v", rows_per_task)
    known = F.when(F.col("__v").isNotNull(), F.col("__n"))
    if cuts is None:
        # placed by key first: counting by (key, value), ranking and the results need no other shuffle
        placed = rows.repartition(*names) if names else rows
        counts = placed.groupBy(*names, "__v").agg(F.count(F.lit(1)).alias("__n"))
        whole = Window.partitionBy(*names)
        upto = F.sum(known).over(whole.orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
        run = counts.withColumns({"__upto": upto, "__all": F.sum(known).over(whole)})
    else:
        counts = settled(rows.groupBy(*names, "__v").agg(F.count(F.lit(1)).alias("__n")))
        run = with_running(counts, names, "__v", ["__v"], {"__upto": ("sum", known)}, cuts)
        group = F.struct(*names) if names else F.struct(F.lit(0).alias("one"))
        totals = counts.groupBy(group.alias("__g")).agg(F.sum(known).alias("__all"))
        run = run.withColumn("__g", group).join(totals, "__g").drop("__g")
    how = {
        "rows": F.sum("__n"), "count": F.coalesce(F.sum(known), F.lit(0)), "avg": F.try_divide(F.sum(F.col("__v") * F.col("__n")), F.sum(known)),
        "min": F.min("__v"), "max": F.max("__v"),
    }
    reached = [F.min(F.when(F.col("__v").isNotNull() & (F.col("__upto") >= F.ceil(F.col("__all") * share)), F.col("__v"))).alias(n) for n, share in shares.items()]
    return run.groupBy(*names).agg(*[how[k].alias(n) for n, k in aggs.items()], *reached)


def value_stats(df: DataFrame, value: str, keys: Sequence[str | Column] = (), p: float = 0.95, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Count, average, maximum and an upper percentile."""
    aggs = {"count": "rows", "average": "avg", "maximum": "max"}
    return with_percentiles(df, value, keys, {"percentile": p}, aggs, rows_per_task)


def percentile_table(df: DataFrame, value: str, keys: Sequence[str | Column], at_least: int = 5, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Percentiles 50/90/95/99 with count, average and range; small groups are left out."""
    aggs = {"count": "count", "average": "avg", "minimum": "min", "maximum": "max"}
    shares = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    return with_percentiles(df, value, keys, shares, aggs, rows_per_task).where(F.col("count") >= at_least)


# The three levels of the hierarchy.
GRANULARITIES = [("minute", "1 minute"), ("hour", "1 hour"), ("day", "1 day")]


def multi_granularity(df: DataFrame, time: str, item: str, quantity: str) -> DataFrame:
    """Minute, hour and day statistics in one result.

    The rows are reduced once to (minute, item); hours and days are built from
    those partial results, so the table is read and shuffled a single time.
    Streams keep one state per level instead and use approximate item counts.
    """
    if df.isStreaming:
        levels = []
        for name, size in GRANULARITIES:
            agg = df.groupBy(F.window(time, size)).agg(
                F.sum(quantity).alias("total"), F.count(F.lit(1)).alias("count"),
                F.approx_count_distinct(item).alias("items"), F.avg(quantity).alias("average"),
            )
            levels.append(agg.select(F.lit(name).alias("granularity"), "window.start", "window.end", "total", "count", "items", "average"))
        return union_all(*levels)
    minutes = df.groupBy(F.window(time, GRANULARITIES[0][1]).start.alias("__m"), F.col(item).alias("__i")).agg(
        F.sum(quantity).alias("__s"), F.count(F.lit(1)).alias("__n"), F.count(quantity).alias("__q")
    )
    starts = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("granularity"),
                    F.timestamp_seconds(F.floor(F.unix_seconds("__m") / seconds(size)) * seconds(size)).alias("start"),
                    F.lit(seconds(size)).alias("width"),
                )
                for name, size in GRANULARITIES
            ]
        )
    )
    per_item = (
        minutes.withColumn("__w", starts).groupBy("__w", "__i")
        .agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n"), F.sum("__q").alias("__q"))
    )
    out = per_item.groupBy("__w").agg(
        F.sum("__s").alias("total"), F.sum("__n").alias("count"), F.count("__i").alias("items"),
        F.try_divide(F.sum("__s"), F.sum("__q")).alias("average"),
    )
    end = F.timestamp_seconds(F.unix_seconds("__w.start") + F.col("__w.width"))
    return out.select("__w.granularity", "__w.start", end.alias("end"), "total", "count", "items", "average")


def char_count(df: DataFrame, column: str, keys: Sequence[str | Column] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.length(column)).alias("chars"))


def events_per_experiment(df: DataFrame, experiment: str) -> DataFrame:
    return df.groupBy(experiment).agg(F.count(F.lit(1)).alias("total_events"))


def active_sessions(df: DataFrame, session: str, time: str, asof: Column, seconds_active: int = 300) -> DataFrame:
    """Sessions by age: active means first seen less than five minutes before ``asof``."""
    first = df.groupBy(session).agg(F.min(time).alias("first_seen"))
    young = F.unix_micros(asof) - F.unix_micros("first_seen") < seconds_active * 1_000_000
    return first.agg(F.count_if(young).alias("active_sessions"), F.count(F.lit(1)).alias("sessions"))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values; on a stream with a watermark the state is bounded by it."""
    return df.select(column).distinct()


def partition_by_predicate(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(rows for which the rule holds, all others including null)."""
    holds = F.coalesce(rule, F.lit(False))
    return df.where(holds), df.where(~holds)
