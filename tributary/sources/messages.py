"""Key/value messages: broker topics, Avro payloads.

The broker and Avro formats come in separate Spark packages.  Where they are
missing, the same plans run on tables with the message columns
``key, value, topic, partition, offset, timestamp``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MESSAGE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

# Fixed value: the Avro record of a car; horsepower may be missing.
CAR_AVRO_SCHEMA = json.dumps(
    {
        "type": "record", "name": "Car", "fields": [
            {"name": "Name", "type": "string"}, {"name": "Horsepower", "type": ["long", "null"]}, {"name": "Origin", "type": "string"},
        ],
    }
)


def has_class(spark: SparkSession, name: str) -> bool:
    try:
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(name)
        return True
    except Exception:
        return False


def has_broker(spark: SparkSession) -> bool:
    return has_class(spark, "org.apache.spark.sql.kafka010.KafkaSourceProvider")


def has_avro(spark: SparkSession) -> bool:
    return has_class(spark, "org.apache.spark.sql.avro.CatalystDataToAvro")


def read_topic(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None, starting: str = "latest") -> DataFrame:
    """A topic as a stream, at most ``max_per_trigger`` messages per micro-batch."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting)
    return (reader.option("maxOffsetsPerTrigger", max_per_trigger) if max_per_trigger else reader).load()


def read_message_files(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Stored messages as a stream of the same shape."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send ``key, value`` rows; the checkpoint is what makes restarts safe."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def decode_avro(df: DataFrame, column: str = "value", schema: str = CAR_AVRO_SCHEMA) -> DataFrame:
    """Avro bytes to columns."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col(column), schema).alias("record")).select("record.*")
