"""Interval text such as ``10 minutes`` as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(text: str) -> int:
    count, unit = text.split()
    return int(count) * _SECONDS[unit.rstrip("s")]


def floor_div(x: Column, width: int) -> Column:
    """Integer division rounding down, exact for microsecond counts."""
    return ((x - F.pmod(x, F.lit(width))) / width).cast("bigint")
