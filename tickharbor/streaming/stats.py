"""Event-time window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import event_time
from .ingest import TRIGGER
from .batches import start_batches
from .runs import read_changes, write_changes
from .snapshots import write_snapshot

_KEYS = ("window_start", "window_end", "ticker")


def windowed_ticker_stats(
    ticks: DataFrame,
    window: str = "1 hour",
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Row count and average, lowest and highest price per window and ticker.

    Tumbling windows, or sliding ones with ``slide``. On a stream, ``watermark`` bounds how late
    a row may be and lets finished windows leave the state; on a batch it has no effect.
    """
    timed = ticks.withColumn("ts", event_time(F.col("ts"), ticks.schema["ts"].dataType))
    if watermark is not None and timed.isStreaming:
        timed = timed.withWatermark("ts", watermark)
    frame = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (
        timed.groupBy(frame.alias("window"), "ticker")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "ticker",
            "total_records",
            "avg_price",
            "min_price",
            "max_price",
        )
    )


def write_window_stats(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Write window statistics as they develop.

    ``append`` writes each window once, after the watermark has passed its end, through the
    exactly-once file sink. ``update`` adds what changed in each batch, open windows too, and merges the
    changes as they grow in number, while the watermark keeps the state bounded; read it with :func:`read_window_stats`. ``complete`` replaces
    the whole result after every batch and keeps every window in the state: for short or bounded
    streams; read it with ``read_newest_snapshot``. Use one ``path`` per checkpoint.
    """
    if mode not in ("append", "update", "complete"):
        raise ValueError(f"mode must be 'append', 'update' or 'complete', not {mode!r}")
    if mode == "update":
        return start_batches(
            stats, checkpoint, lambda rows, _, batch_id: write_changes(rows, path, batch_id, _KEYS), trigger, available_now, mode
        )
    writer = stats.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if mode == "append":
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.foreachBatch(lambda batch, batch_id: write_snapshot(batch, path, batch_id))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_window_stats(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every window that ``update`` mode has written, from a bounded number of files (``runs``)."""
    return read_changes(spark, path, _KEYS)
