"""Continuously refreshed newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranked import latest_ticks
from .snapshots import read_newest_snapshot, read_snapshot, write_snapshot


def latest_ticks_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    trigger: str = "5 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the newest ``n`` rows of a tick stream in a table at ``path``.

    Each batch merges its own top ``n`` with that of the batch before. A repeated batch starts
    from the same predecessor, so the outcome does not depend on retries. Use one ``path`` per
    checkpoint.
    """
    schema = stream.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        known = read_snapshot(batch.sparkSession, path, batch_id - 1, schema)
        write_snapshot(latest_ticks(known.unionByName(batch), n).coalesce(1), path, batch_id)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_latest_ticks(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The rows that :func:`latest_ticks_stream` keeps, newest first."""
    return latest_ticks(read_newest_snapshot(spark, path), n)
