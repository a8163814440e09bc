"""Top-k, ranking and best sellers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scalar import bracket
from tributary.operators.ordered import ROWS_PER_TASK, bucket_cuts, with_running
from tributary.operators.windows import sliding, tumbling


def top_k(df: DataFrame, score: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The k rows with the highest score; each task forwards only its own k."""
    return df.orderBy(F.desc(score), *tie_break).limit(k)


def top_k_per(df: DataFrame, groups: Sequence[str], score: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The k best rows of each group with their ``rank``.

    Spark limits each group to k rows before the shuffle, so a hot group does
    not travel whole.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc(score), *tie_break)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_sellers(df: DataFrame, time: str, item: str, quantity: str, size: str = "1 day", slide: str | None = None) -> DataFrame:
    """Quantity per item and window, best first inside a window."""
    aggs = {"total": ("sum", quantity)}
    sold = sliding(df, time, size, slide, aggs, [item]) if slide else tumbling(df, time, size, aggs, [item])
    return sold.orderBy("start", F.desc("total"), item)


def best_seller(df: DataFrame, time: str, item: str, quantity: str, size: str = "1 day", slide: str | None = None) -> DataFrame:
    """Only the best item of each window."""
    aggs = {"total": ("sum", quantity)}
    sold = sliding(df, time, size, slide, aggs, [item]) if slide else tumbling(df, time, size, aggs, [item])
    return top_k_per(sold, ["start", "end"], "total", [item], 1).drop("rank")


def popular_hashtags(df: DataFrame, time: str, tag: str, size: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Hashtag counts per sliding window, most used first."""
    return sliding(df, time, size, slide, {"count": ("count", "*")}, [tag]).orderBy("start", F.desc("count"), tag)


def top_hashtags(df: DataFrame, time: str, tag: str, k: int = 5, size: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    counts = sliding(df, time, size, slide, {"count": ("count", "*")}, [tag])
    return top_k_per(counts, ["start", "end"], "count", [tag], k)


def percent_rank_limit(df: DataFrame, group: str, value: str, p: float, few_groups: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per group the largest value whose percent_rank is at most ``p``.

    Equal values are counted first; the counts are summed up in the order of
    the values, where a large group is cut at quantiles.  ``few_groups`` says
    that the groups are a short fixed list, so that a row per group can be
    broadcast.
    """
    small = F.broadcast if few_groups else (lambda d: d)
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    size = counts.groupBy(group).agg(F.sum("__n").alias("__all"))
    cuts = bucket_cuts(counts, [group], value, rows_per_task)
    run = with_running(counts, [group], value, [value], {"__before": ("sum", F.col("__n"))}, cuts, inclusive=False)
    before = F.coalesce("__before", F.lit(0))
    fits = (F.col("__all") == 1) | (before / (F.col("__all") - 1) <= p)
    return run.join(small(size), group).where(fits).groupBy(group).agg(F.max(value).alias("limit"))


def bottom_percent(df: DataFrame, group_of: str, value: str, p: float = 0.1, group: str = "bracket", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows in the lowest ``p`` share of their bracket by ``value`` (both non-null).

    Batch form; on a stream call it inside ``foreachBatch``.
    """
    rows = df.dropna(subset=[group_of, value]).withColumn(group, bracket(group_of))
    limits = percent_rank_limit(rows, group, value, p, True, rows_per_task)
    # one row per bracket, and the brackets are fixed
    return rows.join(F.broadcast(limits), group).where(F.col(value) <= F.col("limit")).drop("limit")
