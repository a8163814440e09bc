"""Sinks.  Functions that return ``fn(batch, batch_id)`` are for ``foreachBatch``.

Everything keyed by the batch id can be repeated: after a failure the same
batch overwrites its own folder, so results are neither lost nor doubled.
"""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, Row, StructType

from tributary.sources.files import write_json

BatchFn = Callable[[DataFrame, int], None]


def child_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``<prefix>=N`` below ``path``, sorted."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{prefix}=") and fs.exists(done):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def text_per_batch(path: str, column: str = "value") -> BatchFn:
    """Each micro-batch as text in a folder of its own."""
    return lambda batch, n: batch.select(F.col(column).cast("string")).write.mode("overwrite").text(f"{path}/batch={n}")


def json_per_batch(path: str) -> BatchFn:
    return lambda batch, n: write_json(batch, f"{path}/batch={n}")


def exactly_once(path: str) -> BatchFn:
    """Parquet table partitioned by batch; a repeated batch replaces itself."""
    return lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch_id={n}")


def batch_counts(path: str, key: str) -> BatchFn:
    """Only the counts per key of each micro-batch leave it."""

    def write(batch: DataFrame, n: int) -> None:
        batch.groupBy(key).agg(F.count(F.lit(1)).alias("count")).write.mode("overwrite").parquet(f"{path}/batch_id={n}")

    return write


def split_to(path: str, split: Callable[[DataFrame], dict[str, DataFrame]]) -> BatchFn:
    """Several outputs of one micro-batch, each in its own table below ``path``."""

    def write(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            for name, part in split(batch).items():
                part.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={n}")
        finally:
            batch.unpersist()

    return write


def slug(column: str | Column) -> Column:
    """Lower case with everything but a-z and 0-9 removed."""
    return F.regexp_replace(F.lower(column), "[^a-z0-9]", "")


def table_per_value(path: str, column: str, prefix: str = "cars_") -> BatchFn:
    """Route rows to one folder per value: ``table=<prefix><slug>``."""

    def write(batch: DataFrame, n: int) -> None:
        routed = batch.withColumn("table", F.concat(F.lit(prefix), slug(column)))
        routed.write.mode("overwrite").partitionBy("table").parquet(f"{path}/batch_id={n}")

    return write


class KeyedTable:
    """A last-write-wins table on plain files.

    A batch only writes its own changes (``changes/batch_id=N``).  Every
    ``compact_every`` batches the current state becomes ``snapshot/v=N``; reads
    merge the newest finished snapshot with the changes after it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType, compact_every: int = 10):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema
        self.compact_every = compact_every
        self.rest = [f.name for f in schema.fields if f.name not in self.keys]

    def _latest(self, df: DataFrame, version: Column) -> DataFrame:
        rest = F.struct(*self.rest)
        # equal versions: the largest row, so that a repeated batch gives the same table
        newest = df.groupBy(*self.keys).agg(F.max_by(rest, F.struct(version, rest)).alias("__v"))
        return newest.select(*self.keys, "__v.*")

    def upsert(self, order: str) -> BatchFn:
        """Keep the row with the highest ``order`` per key of a batch."""

        def write(batch: DataFrame, n: int) -> None:
            names = self.schema.fieldNames()
            self._latest(batch.select(*names), F.col(order)).write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={n}")
            if (n + 1) % self.compact_every == 0:
                self.compact(n)

        return write

    def read(self, upto: int | None = None) -> DataFrame:
        snapshots = [v for v in child_numbers(self.spark, f"{self.path}/snapshot", "v") if upto is None or v <= upto]
        base = snapshots[-1] if snapshots else -1
        changes = [n for n in child_numbers(self.spark, f"{self.path}/changes", "batch_id") if n > base and (upto is None or n <= upto)]
        frames = [
            self.spark.read.schema(self.schema).parquet(f"{self.path}/changes/batch_id={n}").withColumn("__n", F.lit(n)) for n in changes
        ]
        if base >= 0:
            frames.append(self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshot/v={base}").withColumn("__n", F.lit(base)))
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return self._latest(out, F.col("__n"))

    def compact(self, n: int) -> None:
        self.read(n).write.mode("overwrite").parquet(f"{self.path}/snapshot/v={n}")


def counter_increments(path: str, key: str) -> BatchFn:
    """Increments per key and batch; :func:`read_counters` adds them up."""
    return batch_counts(path, key)


def read_counters(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).groupBy(key).agg(F.sum("count").alias("view_count"))


def merge_upsert(target: DataFrame, batch: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """The target after the batch: equal keys get ``columns``, new keys are added, the rest stays.

    Several rows of one key in the batch count as the one with the highest
    ``order``.
    """
    fresh = batch.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(order, F.struct(*columns))).alias("__new")).withColumnRenamed(key, "__key")
    joined = target.join(fresh, F.col(key) == F.col("__key"), "full")
    hit = F.col("__new").isNotNull()
    return joined.select(
        F.coalesce(key, "__key").alias(key),
        *[F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns if c != key],
    )


def sql_type(data_type) -> str:
    return "BIGINT" if isinstance(data_type, LongType) else "DOUBLE PRECISION" if isinstance(data_type, DoubleType) else "TEXT"


def missing_columns(existing: Iterable[str], schema: StructType) -> list[tuple[str, str]]:
    """Columns (and SQL types) of ``schema`` the table lacks; case does not matter."""
    known = {c.lower() for c in existing}
    return [(f.name, sql_type(f.dataType)) for f in schema.fields if f.name.lower() not in known]


def alter_statements(table: str, existing: Iterable[str], schema: StructType) -> list[str]:
    return [f"ALTER TABLE {table} ADD COLUMN {name} {kind}" for name, kind in missing_columns(existing, schema)]


def append_evolving(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; columns match by name in any case, missing ones are null."""
    names = {c.lower(): c for c in target.columns}
    return target.unionByName(batch.toDF(*[names.get(c.lower(), c) for c in batch.columns]), allowMissingColumns=True)


def jdbc_append(url: str, table: str, properties: dict[str, str], mode: str = "append") -> BatchFn:
    """Each batch to a database table; one transaction per partition."""
    return lambda batch, n: batch.write.jdbc(url, table, mode, properties)


def jdbc_merge(url: str, table: str, staging: str, key: str, columns: Sequence[str], properties: dict[str, str],
               execute: Callable[[str], None], order: str) -> BatchFn:
    """Stage the newest row per key by ``order``, then ``INSERT ... ON CONFLICT DO UPDATE`` from the staging table."""
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns)
    names = ", ".join([key, *columns])
    statement = f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({key}) DO UPDATE SET {updates}"

    def write(batch: DataFrame, n: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(order, F.struct(*columns))).alias("__v")).select(key, "__v.*")
        newest.write.jdbc(url, staging, "overwrite", properties)
        execute(statement)

    return write


class TransactionalWriter:
    """Row writer for ``writeStream.foreach``: a partition commits whole or not at all.

    ``connect()`` returns a DB-API connection.  Nulls are bound as nulls.
    ``accept(partition, epoch)`` may skip a chunk that was written before.
    """

    def __init__(self, connect: Callable[[], object], statement: str, columns: Sequence[str], accept: Callable[[int, int], bool] | None = None):
        self.connect, self.statement, self.columns, self.accept = connect, statement, list(columns), accept

    def open(self, partition_id: int, epoch_id: int) -> bool:
        if self.accept and not self.accept(partition_id, epoch_id):
            return False
        self.connection = self.connect()
        self.cursor = self.connection.cursor()
        return True

    def process(self, row: Row) -> None:
        self.cursor.execute(self.statement, tuple(row[c] for c in self.columns))

    def close(self, error: Exception | None) -> None:
        connection = getattr(self, "connection", None)
        if connection is None:
            return
        try:
            connection.rollback() if error else connection.commit()
        finally:
            connection.close()


def push_partitions(send: Callable[[list[Row]], None], chunk: int = 100, attempts: int = 5, first_wait: float = 0.5, longest_wait: float = 10.0) -> BatchFn:
    """Push every partition to an external receiver in chunks, retrying with doubling waits."""

    def deliver(rows: list[Row]) -> None:
        wait = first_wait
        for attempt in range(attempts):
            try:
                send(rows)
                return
            except Exception:
                if attempt == attempts - 1:
                    raise
                clock.sleep(wait)
                wait = min(wait * 2, longest_wait)

    def push(rows: Iterator[Row]) -> None:
        held: list[Row] = []
        for row in rows:
            held.append(row)
            if len(held) == chunk:
                deliver(held)
                held = []
        if held:
            deliver(held)

    return lambda batch, n: batch.foreachPartition(push)


def paced(write_row: Callable[[Row], None], permits_per_second: float = 10, now=clock.monotonic, sleep=clock.sleep) -> Callable[[Iterator[Row]], None]:
    """Partition writer that never exceeds the permitted rate."""

    def write(rows: Iterator[Row]) -> None:
        due = now()
        for row in rows:
            if due > now():
                sleep(due - now())
            write_row(row)
            due = max(due, now()) + 1.0 / permits_per_second

    return write


def rate_limited_upsert(write_row: Callable[[Row], None], key: str, order: str, permits_per_second: float = 10) -> BatchFn:
    """Upsert the newest row per key, every partition at the permitted rate."""

    def write(batch: DataFrame, n: int) -> None:
        rest = [c for c in batch.columns if c != key]
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, F.struct(*rest))).alias("__v")).select(key, "__v.*")
        newest.foreachPartition(paced(write_row, permits_per_second))

    return write


def chunked_ack(df: DataFrame, send: Callable[[list[Row]], None], n: int = 100) -> DataFrame:
    """Send each partition on in chunks of ``n`` rows; one ``(part, chunk, size)`` row per chunk the receiver took.

    The next chunk goes out when ``send`` has returned; if it raises, the task
    fails and is repeated, so a receiver may see a chunk twice.
    """
    row = Row(*df.columns)

    def ack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, held = 0, []
        part = TaskContext.get().partitionId()

        def delivered(size: int) -> pd.DataFrame:
            nonlocal chunk, held
            send(held[:size])
            held, chunk = held[size:], chunk + 1
            return pd.DataFrame({"part": [part], "chunk": [chunk - 1], "size": [size]})

        for pdf in batches:
            held += [row(*values) for values in pdf.itertuples(index=False, name=None)]
            while len(held) >= n:
                yield delivered(n)
        if held:
            yield delivered(len(held))

    return df.mapInPandas(ack, "part int, chunk bigint, size bigint")
