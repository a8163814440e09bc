"""Joins of streams whose rows are kept as files.

Without a time predicate nothing ever leaves the state of a join, and a state
store takes every row of it one by one.  Here the rows of both sides are stored
per micro-batch, and each micro-batch is joined, as tables are, to what came
before it.  Each one reads what is stored, so this is for few, large
micro-batches.  A repeated micro-batch replaces its own rows and results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tributary.operators.joins import join_on
from tributary.streaming.sinks import BatchFn


def two_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """One stream of both, for :func:`joined_to`."""
    sides = [df.select(F.lit(s).alias("side"), F.struct("*").alias(s)) for s, df in (("left", left), ("right", right))]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def joined_to(
    spark: SparkSession, kept: str, out: str, left_key: str, right_key: str, columns: Sequence[str],
    times: tuple[str, str] | None = None, delay_seconds: float = 0.0,
) -> BatchFn:
    """``columns`` of the inner equi-join of both sides, new pairs per micro-batch in ``out``.

    ``kept`` holds the rows.  With ``times``, the time columns of the sides,
    rows at or behind the watermark are dropped: the newest time of the side
    that lags, as of the micro-batches before, less the delay.  Rows without a
    time are not late.
    """

    def write(batch: DataFrame, n: int) -> None:
        schema = StructType([*batch.drop("side").schema.fields, StructField("side", StringType()), StructField("batch_id", LongType())])
        stored = lambda: spark.read.schema(schema).parquet(kept)
        if times and n > 0:
            at = {s: F.unix_micros(F.col(f"{s}.{c}")) for s, c in zip(("left", "right"), times)}
            newest = stored().where(F.col("batch_id") < n).agg(*[F.max(c) for c in at.values()]).first()
            if None not in newest:
                limit = (min(newest) // 1000 - round(delay_seconds * 1000)) * 1000
                batch = batch.where(F.coalesce(*at.values(), F.lit(limit + 1)) > limit)
        batch.write.mode("overwrite").partitionBy("side").parquet(f"{kept}/batch_id={n}")

        def rows(side: str, before: bool | None = None) -> DataFrame:
            wanted = {None: F.col("batch_id") <= n, True: F.col("batch_id") < n, False: F.col("batch_id") == n}[before]
            return stored().where((F.col("side") == side) & wanted).select(f"{side}.*")

        pairs = join_on(rows("left", before=False), rows("right"), left_key, right_key).select(*columns)
        if n > 0:
            pairs = pairs.unionByName(join_on(rows("left", before=True), rows("right", before=False), left_key, right_key).select(*columns))
        pairs.write.mode("overwrite").parquet(f"{out}/batch_id={n}")

    return write
