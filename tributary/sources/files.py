"""File sources, static and streaming, and named SQL over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Schema = str | StructType


def _stream(spark: SparkSession, max_files: int | None, max_bytes: str | None = None):
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def read_csv_stream(spark: SparkSession, path: str, schema: Schema, date_format: str = "MMM d yyyy",
                    max_files: int | None = None) -> DataFrame:
    """Headerless CSV files as they appear in a folder."""
    return _stream(spark, max_files).schema(schema).option("dateFormat", date_format).csv(path)


# JSON text keeps microseconds; Spark's default would cut them to milliseconds.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("timestampFormat", JSON_TIME).json(path)


def read_json_stream(spark: SparkSession, path: str, schema: Schema, max_files: int | None = None) -> DataFrame:
    return _stream(spark, max_files).schema(schema).json(path)


def read_json_static(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """JSON lines; without a schema one is inferred (an extra pass over the files)."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Text lines as one ``value`` column."""
    return _stream(spark, max_files).text(path)


def read_rate(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    """Counting rows ``(timestamp, value)`` from the clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def read_rate_batches(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, advance_ms: int = 1000) -> DataFrame:
    """Counting rows whose times depend only on the batch number."""
    return (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms).option("advanceMillisPerBatch", advance_ms).load()
    )


def watch_directory(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Lines of files added to ``path``, up to ``max_files`` files per micro-batch."""
    return read_lines(spark, path, max_files)


def watch_many(spark: SparkSession, pattern: str, max_files: int | None = None) -> DataFrame:
    """Lines from every folder matching ``pattern``; folders made later are found too."""
    return read_lines(spark, pattern, max_files)


def read_rate_limited(spark: SparkSession, path: str, schema: Schema, file_format: str = "parquet",
                      max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Admission control at the source: the rest waits for the next trigger."""
    return _stream(spark, max_files, max_bytes).schema(schema).format(file_format).load(path)


def with_file_position(df: DataFrame) -> DataFrame:
    """Where each row came from."""
    return df.select("*", "_metadata.file_name", "_metadata.file_block_start")


def rows_to_df(spark: SparkSession, rows: Iterable[tuple], schema: Schema) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def register_sql(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL with ``{name}`` standing for the given frames."""
    return spark.sql(text, **frames) if frames else spark.sql(text)
