"""Replay a table as a stream in fixed, time-ordered micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tributary.session import estimated_bytes, settled, streaming_session, work_dir

FILE_BYTES = 16 * 1024 * 1024  # a file is the least that a task writes or reads
LEAST_ROWS = 1_000
_STAGED: dict[tuple, Staged] = {}


class Staged:
    """A folder of slices; each slice has the same number of files."""

    def __init__(self, path: str, schema, files_per_slice: int, slices: int, rows: int):
        self.path, self.schema = path, schema
        self.files_per_slice, self.slices, self.rows = files_per_slice, slices, rows

    def stream(self, spark: SparkSession) -> DataFrame:
        """One slice per micro-batch."""
        reader = spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files_per_slice)
        return reader.parquet(self.path)


def file_states(df: DataFrame) -> int:
    """A number that changes when a file that ``df`` reads is written anew."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    states = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        states.append((name, status.getModificationTime(), status.getLen()))
    return hash(tuple(states))


def stage(df: DataFrame, time: str, slice_seconds: int, name: str, most: int | None = None, closing_seconds: int | None = None) -> Staged:
    """Write ``df`` cut by time, oldest slice first.

    Slices are written one after the other, since a file stream picks files in
    the order they were modified.  A large slice has several files, so it is
    written and read in parallel.  Rows without a time come first.  Staging happens once per application,
    ``name`` and state of the table's files.  Where the cut does not matter,
    ``most`` bounds the number of slices: they get longer.  With
    ``closing_seconds`` a copy of the newest row that much later comes last; it
    takes the watermark past all rows and is itself still ahead of it.
    """
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, name, time, slice_seconds, most, closing_seconds, tuple(df.columns), file_states(df))
    if key in _STAGED:
        return _STAGED[key]
    if "Join " in df._jdf.queryExecution().optimizedPlan().toString():
        df = settled(df)  # the estimate of a join is the product of its sides; the join runs once, not once a slice
    number = F.floor(F.unix_seconds(time) / slice_seconds)
    if most:
        first, last = df.agg(F.min(number), F.max(number)).first()
        if first is not None and last - first >= most:
            slice_seconds *= -(-(last - first + 1) // (most - 1))  # the first slice may begin before the first row
            number = F.floor(F.unix_seconds(time) / slice_seconds)
    sizes = dict(df.groupBy(number.alias("n")).count().where("n is not null").collect())
    slices = sorted(sizes)
    files = -(-estimated_bytes(df) // (max(1, len(slices)) * FILE_BYTES))
    files = max(1, min([files, *(n // LEAST_ROWS for n in sizes.values())]))  # no file may be without rows: it would not be written
    path = work_dir(spark, "staged")
    for n in slices:
        lo, hi = F.timestamp_seconds(F.lit(n * slice_seconds)), F.timestamp_seconds(F.lit((n + 1) * slice_seconds))
        wanted = (F.col(time) >= lo) & (F.col(time) < hi)
        part = df.where(wanted | F.col(time).isNull() if n == slices[0] else wanted)
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    if closing_seconds is not None:
        newest = df.agg(F.max(time)).first()[0]
        later = df.where(F.col(time) == F.lit(newest)).limit(1).withColumn(time, F.col(time) + F.make_dt_interval(secs=F.lit(closing_seconds)))
        later.coalesce(1).write.mode("append").parquet(path)
    _STAGED[key] = Staged(path, df.schema, files, len(slices), sum(sizes.values()))
    return _STAGED[key]


def run(query: StreamingQuery) -> StreamingQuery:
    """Wait until everything available has been processed."""
    query.awaitTermination()
    return query


def replay(
    spark: SparkSession,
    build: Callable[[SparkSession], DataFrame],
    mode: str = "append",
    update_keys: Sequence[str] = (),
    conf: dict[str, str] | None = None,
    on_finish: Callable[[StreamingQuery], None] | None = None,
) -> DataFrame:
    """Run a streaming plan over all available input and return its result table.

    ``build`` receives a sibling session with streaming settings and returns
    the streaming result.  Append results come from the file sink.  In complete
    mode each batch writes a full version and the last one counts; in update
    mode the latest row per ``update_keys`` counts.
    """
    sibling = streaming_session(spark, **(conf or {}))
    result = build(sibling)
    out, schema = work_dir(spark, "result"), result.schema
    writer = result.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", work_dir(spark, "checkpoint"))
    if mode == "append":
        query = run(writer.format("parquet").option("path", out).start())
        if on_finish:
            on_finish(query)
        return spark.read.schema(schema).parquet(out)

    last: list[int] = []

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        last.append(batch_id)

    query = run(writer.foreachBatch(save).start())
    if on_finish:
        on_finish(query)
    if mode == "complete":
        return spark.read.schema(schema).parquet(f"{out}/batch_id={last[-1]}")
    rest = [f.name for f in schema.fields if f.name not in update_keys]
    versions = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(out)
    newest = versions.groupBy(*update_keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__v"))
    return newest.select(*update_keys, "__v.*")


def for_each_batch(
    spark: SparkSession, build: Callable[[SparkSession], DataFrame], fn: Callable[[DataFrame, int], None],
    mode: str = "append", checkpoint: str | None = None,
) -> StreamingQuery:
    """Feed every micro-batch of a streaming plan to ``fn(batch, batch_id)``."""
    stream = build(streaming_session(spark))
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True)
    return run(writer.option("checkpointLocation", checkpoint or work_dir(spark, "checkpoint")).foreachBatch(fn).start())
