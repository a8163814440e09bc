"""Control data that may change while a stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.filters import keyword_filter, threshold_filter
from tributary.operators.joins import lookup_with_default
from tributary.streaming.sinks import BatchFn

Load = Callable[[SparkSession, int], DataFrame]


def with_control(load: Load, apply: Callable[[DataFrame, DataFrame], DataFrame], write: BatchFn) -> BatchFn:
    """Read the control table anew for every micro-batch and apply it."""
    return lambda batch, n: write(apply(batch, load(batch.sparkSession, n)), n)


def refreshing_lookup(load: Load, key: str, names_key: str, name: str, write: BatchFn, default: str = "N/A") -> BatchFn:
    """Add ``name`` from a reference table that may be swapped between batches."""
    return with_control(load, lambda batch, names: lookup_with_default(batch, names, key, names_key, name, default), write)


def dynamic_threshold(load: Load, column: str, write: BatchFn) -> BatchFn:
    """Keep values above the threshold of the moment (0 when there is none)."""
    return with_control(load, lambda batch, limit: threshold_filter(batch, column, limit), write)


def threshold_file(spark: SparkSession, path: str) -> DataFrame:
    """The threshold written in a text file; no rows when the file is missing."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.text(path).select(F.trim("value").alias("threshold"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "threshold string")


def dynamic_keywords(load: Callable[[int], list[str]], text: str, write: BatchFn) -> BatchFn:
    """Keep texts with a keyword of the current list."""
    return lambda batch, n: write(keyword_filter(batch, text, load(n)), n)
