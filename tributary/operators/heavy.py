"""The most frequent items of sliding windows from bounded summaries.

A pane's summary is a Misra-Gries table: at most ``counters`` items with a lower
bound of their counts, and ``missed``, the most that any count can be short by.
Tasks summarise their own rows, summaries of a pane are merged, and a window
takes the items of its panes as candidates.  Candidates are counted again,
exactly.  A window is proven when its k-th count exceeds what any other item
can have, the sum of its panes' ``missed``; the rare windows that are not are
counted in full, so the answer is always that of a full count.  What is kept
per pane does not grow with the number of different items.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.intervals import floor_div, seconds
from tributary.operators.ranking import top_k_per
from tributary.session import settled, ship_package

COUNTERS = 256
ROWS_HELD = 1 << 16
SUMMARY = "pane long, item string, lower long, missed long"


def reduced(counts: Counter, counters: int) -> int:
    """Cut a table to ``counters`` items: all counts lose the largest one that goes, which is returned."""
    if len(counts) <= counters:
        return 0
    loss = sorted(counts.values(), reverse=True)[counters]
    for item, n in list(counts.items()):
        if n <= loss:
            del counts[item]
        else:
            counts[item] = n - loss
    return loss


def batch_of(pane: int, counts: Counter, missed: int) -> Iterator[pa.RecordBatch]:
    """A summary's rows; one without an item carries ``missed``."""
    items, lower = [*counts, None], [*counts.values(), 0]
    yield pa.RecordBatch.from_arrays(
        [pa.array([pane] * len(items), pa.int64()), pa.array(items, pa.string()), pa.array(lower, pa.int64()), pa.array([missed] * len(items), pa.int64())], names=["pane", "item", "lower", "missed"])


def summaries(df: DataFrame, time: str, item: str, pane_seconds: int, counters: int = COUNTERS) -> DataFrame:
    """One merged summary per pane: rows (pane, item, lower, missed)."""
    ship_package(df.sparkSession)

    def own(batches):
        held: dict[int, tuple[Counter, list]] = {}
        rows = 0
        for batch in batches:
            for pane, value, n in zip(*(batch.column(c).to_pylist() for c in ("pane", "item", "n"))):
                counts, missed = held.setdefault(pane, (Counter(), [0]))
                counts[value] += n
                if len(counts) >= 2 * counters:  # amortised: a cut halves the table
                    missed[0] += reduced(counts, counters)
            rows += batch.num_rows
            if len(held) * counters > ROWS_HELD:  # many panes at once: pass on what is there
                for pane, (counts, missed) in held.items():
                    yield from batch_of(pane, counts, missed[0] + reduced(counts, counters))
                held = {}
        for pane, (counts, missed) in held.items():
            yield from batch_of(pane, counts, missed[0] + reduced(counts, counters))

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        missed = 0
        for batch in batches:
            for value, lower, short in zip(*(batch.column(c).to_pylist() for c in ("item", "lower", "missed"))):
                if value is None:
                    missed += short
                else:
                    counts[value] += lower
            if len(counts) >= 4 * counters:
                missed += reduced(counts, counters)
        yield from batch_of(key[0].as_py(), counts, missed + reduced(counts, counters))

    pane = (floor_div(F.unix_seconds(time), pane_seconds) * pane_seconds).cast("long")
    rows = df.where(F.col(item).isNotNull() & F.col(time).isNotNull()).select(pane.alias("pane"), F.col(item).cast("string").alias("item"), F.lit(1).cast("long").alias("n"))
    # a pane has a bounded table from each task; they are merged one batch at a time
    return rows.mapInArrow(own, SUMMARY).groupBy("pane").applyInArrow(merge, SUMMARY)


def top_items(df: DataFrame, time: str, item: str, k: int, size: str, slide: str, counters: int = COUNTERS) -> DataFrame:
    """The ``k`` most frequent items of every sliding window: (start, end, item, count, rank), ties by item."""
    width, step = seconds(size), seconds(slide)
    if width % step:
        raise ValueError("a window is a whole number of slides")
    starts = F.explode(F.sequence(F.col("pane") - (width - step), F.col("pane"), F.lit(step).cast("bigint")))
    tables = settled(summaries(df, time, item, step, counters))
    candidates = tables.where("item is not null").select("item", starts.alias("start")).distinct()
    bounds = tables.where("item is null").select("missed", starts.alias("start")).groupBy("start").agg(F.sum("missed").alias("missed"))

    pane = (floor_div(F.unix_seconds(time), step) * step).cast("long")
    rows = df.where(F.col(item).isNotNull() & F.col(time).isNotNull()).select(pane.alias("pane"), F.col(item).cast("string").alias("item"))
    known = tables.where("item is not null").select("item").distinct()
    counts = settled(rows.join(known, "item", "left_semi").groupBy("pane", "item").agg(F.count(F.lit(1)).alias("n")))
    exact = counts.select("item", "n", starts.alias("start")).join(candidates, ["start", "item"]).groupBy("start", "item").agg(F.sum("n").alias("count"))
    best = top_k_per(exact, ["start"], "count", ["item"], k)
    last = best.groupBy("start").agg(F.count(F.lit(1)).alias("found"), F.min("count").alias("least"))
    proven = bounds.join(last, "start", "left").select("start", ((F.col("missed") == 0) | ((F.col("found") == k) & (F.col("least") > F.col("missed")))).alias("proven"))
    proven = settled(proven.withColumn("proven", F.coalesce("proven", F.lit(False))))
    sure = best.join(proven.where("proven").select("start"), "start")
    open_windows = proven.where("not proven").select("start")
    full = rows.groupBy("pane", "item").agg(F.count(F.lit(1)).alias("n")).select("item", "n", starts.alias("start")).join(open_windows, "start")
    counted = top_k_per(full.groupBy("start", "item").agg(F.sum("n").alias("count")), ["start"], "count", ["item"], k)
    both = sure.unionByName(counted.select(*sure.columns))
    return both.select(F.timestamp_seconds("start").alias("start"), F.timestamp_seconds(F.col("start") + width).alias("end"), F.col("item").alias(item), "count", "rank")
