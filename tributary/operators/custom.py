"""Plugging in user functions: per row batch, per partition, per micro-batch.

Built-in column functions come first; these are for what they cannot express.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tributary.streaming.sinks import BatchFn


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` on Arrow batches of rows: map, filter or flat-map."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def map_partitions(df: DataFrame, start: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """As :func:`map_rows`, with ``start()`` called once per partition to set up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = start()
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def transform_batches(fn: Callable[[DataFrame], DataFrame], write: BatchFn) -> BatchFn:
    """A whole-table function on every micro-batch, sorting and ranking included."""
    return lambda batch, n: write(batch.transform(fn), n)
