"""Triggers, progress and several queries at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, kind: str, interval: str | None = None) -> DataStreamWriter:
    """``every`` interval, ``once`` (all that is available, then stop) or ``continuous``."""
    if kind == "every":
        return writer.trigger(processingTime=interval)
    if kind == "once":
        return writer.trigger(availableNow=True)
    if kind == "continuous":
        return writer.trigger(continuous=interval)
    raise ValueError(f"unknown trigger {kind}")


def _updates(query: StreamingQuery) -> list:
    """Every progress update of the query; raises when Spark has dropped the first ones."""
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    updates = query.recentProgress
    if len(updates) >= kept:
        raise RuntimeError("progress updates were dropped: raise spark.sql.streaming.numRecentProgressUpdates before the query starts")
    return updates


PROGRESS = (
    "name string, batch_id bigint, at string, input_rows bigint, event_time_max string, watermark string,"
    " state_rows bigint, dropped_by_watermark bigint"
)


def progress_table(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """What the queries reported per micro-batch."""
    rows = []
    for q in queries:
        for p in _updates(q):
            times = p["eventTime"] or {}
            states = p["stateOperators"]
            rows.append(
                (
                    p["name"], p["batchId"], p["timestamp"], p["numInputRows"], times.get("max"), times.get("watermark"),
                    sum(s["numRowsTotal"] for s in states), sum(s["numRowsDroppedByWatermark"] for s in states),
                )
            )
    return spark.createDataFrame(rows, PROGRESS)


def dropped_rows(query: StreamingQuery) -> int:
    return sum(s["numRowsDroppedByWatermark"] for p in _updates(query) for s in p["stateOperators"])


def offset_ranges(query: StreamingQuery) -> list[dict]:
    """Start and end offset of every source and micro-batch."""
    return [
        {"batch_id": p["batchId"], "source": s["description"], "start": s["startOffset"], "end": s["endOffset"]}
        for p in _updates(query) for s in p["sources"]
    ]


def run_all(starters: Sequence[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start all queries side by side and wait for every one."""
    queries = [start() for start in starters]
    for q in queries:
        q.awaitTermination()
    return queries
