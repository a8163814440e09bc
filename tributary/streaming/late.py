"""Watermarks, tiers of lateness, and what to do with late rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.aggregates import union_all


@dataclass(frozen=True)
class Tier:
    name: str
    kind: str  # value of the type column
    delay: str
    size: str


# Delay and window of the three tiers.
DEFAULT_TIERS = (
    Tier("critical", "critical", "1 second", "5 seconds"),
    Tier("normal", "normal", "10 seconds", "10 seconds"),
    Tier("batch", "batch", "30 seconds", "30 seconds"),
)


def watermarked_counts(df: DataFrame, time: str, key: str, delay: str = "2 seconds", size: str = "2 seconds") -> DataFrame:
    """Counts per window and key that drop rows behind the watermark."""
    out = df.withWatermark(time, delay).groupBy(F.window(time, size), key).agg(F.count(F.lit(1)).alias("count"))
    return out.select("window.start", "window.end", key, "count")


def tier_counts(df: DataFrame, time: str, kind: str, tier: Tier) -> DataFrame:
    rows = df.where(F.col(kind) == tier.kind)
    return watermarked_counts(rows, time, kind, tier.delay, tier.size).withColumn("source", F.lit(f"{tier.name}_stream"))


def tiered_counts(df: DataFrame, time: str, kind: str, tiers: Sequence[Tier] = DEFAULT_TIERS) -> DataFrame:
    """All tiers in one result.

    In one streaming query the slowest watermark rules them all; run
    :func:`tier_counts` as a query of its own where a tier must come early.
    """
    return union_all(*[tier_counts(df, time, kind, tier) for tier in tiers])


def watermark_impact(df: DataFrame, time: str, latency: str, value: str, delay: str, size: str = "5 seconds") -> DataFrame:
    """Window statistics under one delay, labelled with it."""
    out = df.withWatermark(time, delay).groupBy(F.window(time, size)).agg(
        F.count(F.lit(1)).alias("count"), F.avg(latency).alias("avg_latency"), F.max(latency).alias("max_latency"),
        F.size(F.collect_set(value)).cast("bigint").alias("unique_values"),
    )
    return out.select("window.start", "window.end", "count", "avg_latency", "max_latency", "unique_values", F.lit(delay.replace(" ", "_")).alias("setting"))


def split_late(df: DataFrame, time: str, arrival: str, delay_seconds: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """(rows in time, rows more than the delay behind their arrival)."""
    behind = F.unix_micros(arrival) - F.unix_micros(time) > round(delay_seconds * 1_000_000)
    return df.where(~behind), df.where(behind)
