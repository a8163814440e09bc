"""User functions on Arrow columns: scalar functions and table functions.

Arrow arrays go to the function and come back without rows being made, so a
function written with Arrow's own kernels runs at columnar speed.  Table
functions take a whole table argument, batch by batch in the partitions it has;
this version of Spark gives Arrow table functions neither ``analyze`` nor the
right side of a lateral join, so keys travel through the function instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import ship_package


def column_function(fn: Callable[..., pa.Array], returns: str) -> Callable[..., Column]:
    """``fn`` on Arrow arrays as a column function."""
    n = fn.__code__.co_argcount

    # the function kind is read from type hints, one per argument
    fn.__annotations__ = {**dict.fromkeys(fn.__code__.co_varnames[:n], pa.Array), "return": pa.Array}
    return F.arrow_udf(fn, returns)


def table_function(df: DataFrame, work: Callable[[pa.RecordBatch], pa.Table], schema: str) -> DataFrame:
    """``work`` on every Arrow batch of ``df``, as a table function with a table argument."""
    ship_package(df.sparkSession)

    class Work:
        def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
            yield work(table)

    Work.eval.__annotations__ = {"table": pa.RecordBatch, "return": Iterator[pa.Table]}
    return F.arrow_udtf(Work, returnType=schema)(df.asTable())


def _typed(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def word_rows(df: DataFrame, keys: Sequence[str], text: str, name: str = "word", starting: str | None = None) -> DataFrame:
    """One row per piece between single blanks, those that start with ``starting`` only; null texts have none."""
    keys = list(keys)

    def work(table: pa.RecordBatch) -> pa.Table:
        pieces = pc.split_pattern(table.column("__text"), " ")
        rows, words = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
        if starting is not None:
            kept = pc.starts_with(words, starting)
            rows, words = rows.filter(kept), words.filter(kept)
        return pa.table({**{c: pc.take(table.column(c), rows) for c in keys}, name: words})

    return table_function(df.select(*keys, F.col(text).alias("__text")), work, f"{_typed(df, keys)}, `{name}` string")
