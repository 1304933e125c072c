"""Column names and schemas shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The wire message and the lake layout that existing data uses.
TICK_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.IntegerType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)
PARTITION_COLS = ("year", "month", "day", "hour")
EVENT_TIME_CANDIDATES = ("timestamp", "ts", "time", "event_time")

#: Directory level of a stream's batches, below the hour.
BATCH_COL = "ingest_batch"

LAKE_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        *[T.StructField(name, T.IntegerType()) for name in PARTITION_COLS],
    ]
)

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("last_modified", T.TimestampType()),
    ]
)
