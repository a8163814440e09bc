"""Ordered per-key computations that stay parallel inside a hot key.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task.  When
one key holds a large share of the data that task never ends.  The helpers here
cut the rows of large keys into buckets of about equal numbers of rows, at
quantiles of their order column, compute inside the buckets in parallel, and
carry a small per-bucket total from bucket to bucket.  Results are exact and
independent of the cut.  Keys that are known to fit a task take the plain path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType
from pyspark.sql.window import WindowSpec

from tributary.functions.intervals import floor_div
from tributary.session import plainly_small

ROWS_PER_TASK = 1_000_000
SMALL_INPUT_BYTES = 64 * 1024 * 1024
MOST_BUCKETS = 1_000  # bounds the driver's list of cuts and the plan's search tree, whatever the table's size
FIRST = Window.unboundedPreceding
MEASURE = "measure"  # ask bucket_cuts; pass its answer on to measure only once

Cuts = int | list | None  # buckets of a fixed width in time, from given values on, or none

_COMBINE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda carried, local: F.coalesce(carried + local, carried, local),
    "max": lambda carried, local: F.greatest(carried, local),
    "min": lambda carried, local: F.least(carried, local),
}
_AGG: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}


def _stamp(df: DataFrame, at: str) -> Column:
    """The order column as a number; times in microseconds."""
    return F.unix_micros(at) if isinstance(df.schema[at].dataType, TimestampType) else F.col(at)


def bucket_cuts(df: DataFrame, keys: Sequence[str], at: str, rows_per_task: int = ROWS_PER_TASK) -> list | None:
    """Values of ``at`` where buckets begin, or None when every key fits one task.

    One aggregation (map-side combined) measures the keys.  A second, over the
    rows of the keys that are too large, takes quantiles of ``at``, so that a
    burst or a stray value shifts the cuts and no bucket is much larger than
    ``rows_per_task``; only rows with equal values stay together.  There are at
    most MOST_BUCKETS buckets; beyond that many they hold more rows each.
    """
    if rows_per_task >= ROWS_PER_TASK and plainly_small(df, SMALL_INPUT_BYTES):
        return None
    group = F.struct(*keys) if keys else F.lit(0)
    large = df.groupBy(group.alias("__g")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_task)
    total = large.agg(F.sum("__n")).first()[0]
    if total is None:
        return None
    buckets = min(MOST_BUCKETS, -(-total // rows_per_task))
    shares = [i / buckets for i in range(1, buckets)]
    rows = df.select(group.alias("__g"), _stamp(df, at).alias("__at")).join(large.select("__g"), "__g", "left_semi")
    found = rows.agg(F.percentile_approx("__at", shares, max(10_000, 20 * buckets))).first()[0]
    return sorted(set(found or []))


def bucket_of(at: Column, cuts: Cuts) -> Column:
    """Number of the bucket of a value; a null, first in every order, is in the first."""
    if cuts is None:
        return F.lit(0).cast("bigint")
    if isinstance(cuts, int):
        return F.coalesce(floor_div(at, cuts), F.lit(-(1 << 62)))

    def search(values: list, first: int) -> Column:
        if not values:
            return F.lit(first)
        half = len(values) // 2
        return F.when(at < F.lit(values[half]), search(values[:half], first)).otherwise(search(values[half + 1 :], first + half + 1))

    return F.when(at.isNull(), F.lit(0)).otherwise(search(cuts, 0)).cast("bigint")


_bucket = bucket_of  # the former name


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    totals: dict[str, tuple[str, Column]],
    cuts: Cuts,
    inclusive: bool = True,
) -> DataFrame:
    """Running ``sum`` / ``max`` / ``min`` per key in ``order``.

    ``totals`` maps an output name to (kind, expression).  ``order`` must start
    with ``time``.  With ``inclusive=False`` the current row is left out.
    """
    last = 0 if inclusive else -1
    if cuts is None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(FIRST, last)
        return df.withColumns({name: _AGG[kind](expr).over(frame) for name, (kind, expr) in totals.items()})

    # the keys travel as one struct: it is never null itself, so a plain
    # equi-join also matches null keys and needs no shuffle beyond the window's
    group = [F.struct(*keys).alias("__g")] if keys else []
    by = ["__g", "__b"] if keys else ["__b"]
    df = df.select("*", *group, bucket_of(_stamp(df, time), cuts).alias("__b"))
    frame = Window.partitionBy(*by).orderBy(*order).rowsBetween(FIRST, last)
    local = df.withColumns({name: _AGG[kind](expr).over(frame) for name, (kind, expr) in totals.items()})

    sums = df.groupBy(*by).agg(*[_AGG[kind](expr).alias(f"__c_{name}") for name, (kind, expr) in totals.items()])
    earlier = Window.partitionBy(*by[:-1]).orderBy("__b").rowsBetween(FIRST, -1)
    carry = sums.select(
        *by, *[_AGG[kind](F.col(f"__c_{name}")).over(earlier).alias(f"__c_{name}") for name, (kind, _) in totals.items()]
    )
    combined = local.join(carry, by).withColumns(
        {name: _COMBINE[kind](F.col(f"__c_{name}"), F.col(name)) for name, (kind, _) in totals.items()}
    )
    return combined.drop(*by, *[f"__c_{name}" for name in totals])


def over_last_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    lookback: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    rows_per_task: int = ROWS_PER_TASK,
    position: str = "position",
    cuts: Cuts | str = MEASURE,
) -> DataFrame:
    """Window columns whose frames reach back at most ``lookback`` rows.

    ``columns`` maps a name to a function of the ordered window.  A hot key is
    cut into runs of ``rows_per_task`` rows; each run also receives the last
    ``lookback`` rows before it, so no frame is ever short.  ``position`` is
    the row's 1-based place inside its key.
    """
    if cuts == MEASURE:
        cuts = bucket_cuts(df, keys, time, rows_per_task)
    numbered = with_running(df, keys, time, order, {position: ("sum", F.lit(1).cast("bigint"))}, cuts)
    if cuts is None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return numbered.withColumns({name: make(spec) for name, make in columns.items()})
    if lookback >= rows_per_task:
        raise ValueError("rows_per_task must exceed the lookback")
    place = F.col(position) - 1
    home = floor_div(place, rows_per_task)
    runs = F.when(
        place % rows_per_task >= rows_per_task - lookback, F.array(home, home + 1)
    ).otherwise(F.array(home))
    spread = numbered.withColumn("__home", home).withColumn("__run", F.explode(runs))
    spec = Window.partitionBy(*keys, "__run").orderBy(position)
    filled = spread.withColumns({name: make(spec) for name, make in columns.items()})
    return filled.where(F.col("__home") == F.col("__run")).drop("__home", "__run")


def over_last_interval(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    seconds: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Window columns over the rows of the last ``seconds`` (both ends included)."""
    cuts = bucket_cuts(df, keys, time, rows_per_task)
    reach = seconds * 1_000_000
    stamped = df.withColumn("__us", F.unix_micros(time))
    if cuts is None:
        spec = Window.partitionBy(*keys).orderBy("__us").rangeBetween(-reach, 0)
        return stamped.withColumns({name: make(spec) for name, make in columns.items()}).drop("__us")
    # a row goes to its own bucket and to those that begin within its reach
    home = bucket_of(F.col("__us"), cuts)
    runs = F.sequence(F.col("__home"), bucket_of(F.col("__us") + reach, cuts))
    spread = stamped.withColumn("__home", home).withColumn("__run", F.explode(runs))
    spec = Window.partitionBy(*keys, "__run").orderBy("__us").rangeBetween(-reach, 0)
    filled = spread.withColumns({name: make(spec) for name, make in columns.items()})
    return filled.where(F.col("__home") == F.col("__run")).drop("__home", "__run", "__us")


def collect_in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    order: Sequence[str],
    name: str = "items",
    chunk_size: int = 10_000,
    rows_per_task: int = ROWS_PER_TASK,
    cuts: Cuts | str = MEASURE,
) -> DataFrame:
    """Ordered lists per key, cut in chunks so that no cell grows without bound.

    Output: keys, ``chunk`` (0, 1, ...) and the list.  A key with up to
    ``chunk_size`` rows has exactly one chunk.
    """
    if cuts == MEASURE:
        cuts = bucket_cuts(df, keys, time, rows_per_task)
    placed = with_running(df, keys, time, order, {"__pos": ("sum", F.lit(1).cast("bigint"))}, cuts)
    chunked = placed.withColumn("chunk", floor_div(F.col("__pos") - 1, chunk_size))
    pairs = F.sort_array(F.collect_list(F.struct("__pos", F.col(value).alias("v"))))
    return chunked.groupBy(*keys, "chunk").agg(F.transform(pairs, lambda p: p["v"]).alias(name))
