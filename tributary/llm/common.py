"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id has none and so compares as -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % F.lit(divisor), F.lit(-1))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def runtime_filters(spark: SparkSession):
    """Within this, Spark filters the large side of a shuffled join by a Bloom filter of the small side's keys.

    The filter's size is bounded (spark.sql.optimizer.runtime.bloomFilter.maxNumBits); beyond it
    fewer rows are filtered out before the shuffle, and the join stays exact.
    """
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1t"}
    names = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in wanted.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def touching(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """A test whether a span overlaps any of ``spans``, by their starts and the furthest end so far."""
    ordered = sorted(spans)
    starts, reach = [s[0] for s in ordered], list(accumulate((s[1] for s in ordered), max))

    def test(a: int, b: int) -> bool:
        k = bisect_left(starts, b)
        return k > 0 and reach[k - 1] > a

    return test


def slices(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most_bytes`` of text; a longer text is a run of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    pieces = np.cumsum(lengths) // most_bytes
    starts = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


def map_rows(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most_bytes: int = 1 << 20) -> DataFrame:
    """Row-local work on the rows with a ``text``, about ``most_bytes`` of it at a time, so that memory is bounded."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from map(work, slices(batch, most_bytes))

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], work: Callable[[tuple, pa.Table], Iterator[pa.RecordBatch]], schema: str, partitions: int | None = None) -> DataFrame:
    """Run ``work`` once per group of equal ``keys``, many small groups a task.

    Rows are shuffled and sorted by the keys and streamed, so that a task holds
    one group at a time; the caller keeps groups bounded.
    """
    ship_package(df.sparkSession)
    placed = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None

        def flush():
            if held:
                yield from work(last, pa.concat_tables(held))

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            columns = [table.column(k).to_numpy() for k in keys]
            change = np.zeros(table.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
            for a, b in zip(starts, starts[1:]):
                key = tuple(c[a] for c in columns)
                if last is not None and key != last:
                    yield from flush()
                    held = []
                last = key
                held.append(table.slice(a, b - a))
        yield from flush()

    return placed.sortWithinPartitions(*keys).mapInArrow(run, schema)
