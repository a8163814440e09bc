"""Approximate windows from mergeable sketches kept per pane.

A pane is a short tumbling window; it is aggregated once, to a sketch of a few
kilobytes, and any longer window, day or sliding window is the merge of its
panes' sketches.  Rows are read and shuffled once for all granularities, and on
a stream the state is a sketch per open pane, however many values it has seen.

Quantiles (KLL sketches): with ``k = 400`` the rank of an answer is within
0.7 % of the asked one in 99 of 100 cases, whatever the number of merges.
Distinct counts (HLL sketches): relative standard error 1.04 / sqrt(2^lg_k).
Audiences (theta sketches): set union and intersection; the error of an overlap
is about 1 / sqrt(2^lg_nominal) of the union, and none while the union has
fewer members than 2^lg_nominal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.intervals import floor_div, seconds

QUANTILE_K = 400
RANK_ERROR = 0.007  # of KLL sketches with QUANTILE_K, at 99 %
DISTINCT_LG = 12
AUDIENCE_LG = 12


def panes(df: DataFrame, time: str, size: str, keys: Sequence[str], sketches: dict[str, Column]) -> DataFrame:
    """(window, keys, sketches) per pane; on a stream in append mode once the watermark has passed the pane."""
    return df.groupBy(F.window(time, size).alias("window"), *keys).agg(*[c.alias(n) for n, c in sketches.items()])


def merged(pane_rows: DataFrame, size: str, keys: Sequence[str], merges: dict[str, Column], slide: str | None = None, pane: str | None = None) -> DataFrame:
    """Panes merged to windows: (start, end, keys, sketches).

    On a stream this is a second windowed aggregation over the panes' windows.
    Sliding windows of a table take their panes, ``pane`` long, by exploding
    each pane into the windows that cover it.
    """
    aggs = [c.alias(n) for n, c in merges.items()]
    if pane_rows.isStreaming or slide is None:
        out = pane_rows.groupBy(F.window("window", size).alias("__w"), *keys).agg(*aggs)
        return out.select("__w.start", "__w.end", *keys, *merges)
    width, step, short = seconds(size), seconds(slide), seconds(pane or slide)
    if width % short or step % short or step > width:
        raise ValueError("a window and its slide are whole numbers of panes, and the slide is no longer than the window")
    at = F.unix_seconds("window.start")
    last = floor_div(at, step) * step
    # window starts s with s <= pane start and pane end <= s + width
    first = last - F.floor((last + width - short - at) / step) * step
    rows = pane_rows.withColumn("__s", F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))))
    out = rows.groupBy("__s", *keys).agg(*aggs)
    return out.select(F.timestamp_seconds("__s").alias("start"), F.timestamp_seconds(F.col("__s") + width).alias("end"), *keys, *merges)


# quantiles


def quantile_sketch(value: str, k: int = QUANTILE_K) -> Column:
    return F.kll_sketch_agg_double(F.col(value).cast("double"), k)


def quantile_merge(sketch: str = "sketch", k: int = QUANTILE_K) -> Column:
    return F.kll_merge_agg_double(sketch, k)


def sketched_count(sketch: str = "sketch") -> Column:
    """How many values a sketch has seen, exactly."""
    return F.kll_sketch_get_n_double(sketch)


def sketched_quantiles(df: DataFrame, shares: dict[str, float], sketch: str = "sketch") -> DataFrame:
    """A column per share in place of the sketch."""
    found = df.withColumn("__q", F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(s)) for s in shares.values()])))
    return found.withColumns({n: F.col("__q")[i] for i, n in enumerate(shares)}).drop("__q", sketch)


def rank_errors(rows: DataFrame, value: str, keys: Sequence[str], answers: DataFrame, shares: dict[str, float]) -> DataFrame:
    """How far the exact rank of each answer is from the asked share: (keys, n, <name of the share>...).

    Zero if the share lies between the ranks just below and at the answer.
    """
    joined = rows.where(F.col(value).isNotNull()).join(answers.select(*keys, *shares), list(keys))
    n = F.count(F.lit(1))
    out = []
    for name, share in shares.items():
        below, upto = F.count_if(F.col(value) < F.col(name)) / n, F.count_if(F.col(value) <= F.col(name)) / n
        out.append(F.greatest(F.lit(0.0), below - share, F.lit(share) - upto).alias(name))
    return joined.groupBy(*keys).agg(n.alias("n"), *out)


# distinct values


def distinct_sketch(column: str, lg_k: int = DISTINCT_LG) -> Column:
    return F.hll_sketch_agg(column, lg_k)


def distinct_merge(sketch: str = "sketch") -> Column:
    return F.hll_union_agg(sketch)


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def granularities(df: DataFrame, time: str, item: str, quantity: str, levels: Sequence[tuple[str, str]]) -> DataFrame:
    """Totals, counts and distinct items of several granularities from the panes of the shortest.

    The form of :func:`tributary.operators.aggregates.multi_granularity` whose
    shuffled rows do not grow with the number of items.
    """
    first = panes(df, time, levels[0][1], [], {"items": distinct_sketch(item), "total": F.sum(quantity), "count": F.count(F.lit(1)), "known": F.count(quantity)})
    sums = {"total": F.sum("total"), "count": F.sum("count"), "known": F.sum("known")}
    parts = []
    for name, size in levels:
        out = merged(first, size, [], {"items": distinct_merge("items"), **sums})
        average = F.try_divide(F.col("total"), F.col("known"))
        parts.append(out.select(F.lit(name).alias("granularity"), "start", "end", "total", "count", distinct_estimate("items").alias("items"), average.alias("average")))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


# audiences


def audience_sketch(column: str, lg_nominal: int = AUDIENCE_LG) -> Column:
    return F.theta_sketch_agg(column, lg_nominal)


def audience_merge(sketch: str = "sketch", lg_nominal: int = AUDIENCE_LG) -> Column:
    return F.theta_union_agg(sketch, lg_nominal)


def overlaps(sketches: DataFrame, keys: Sequence[str], group: str, sketch: str = "sketch") -> DataFrame:
    """Members that two groups share, for each pair of groups of equal ``keys``: (keys, one, two, shared, either).

    Pairs are formed of sketches, one per group and key, never of members.
    """
    left = sketches.select(*keys, F.col(group).alias("one"), F.col(sketch).alias("__a"))
    right = sketches.select(*keys, F.col(group).alias("two"), F.col(sketch).alias("__b"))
    both = left.join(right, list(keys)).where("one < two")
    size = lambda c: F.theta_sketch_estimate(c)
    return both.select(*keys, "one", "two", size(F.theta_intersection("__a", "__b")).alias("shared"), size(F.theta_union("__a", "__b")).alias("either"))
