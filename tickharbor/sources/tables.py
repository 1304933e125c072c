"""The supplied ``events`` table seen as ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import add_partition_columns


def events_as_ticks(events: DataFrame) -> DataFrame:
    """ticker = event type, price = value, volume = ``props.k``, plus the hour partition columns."""
    return add_partition_columns(
        events.select(
            F.col("event_type").alias("ticker"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").try_cast("int").alias("volume"),
            F.col("ts").cast("timestamp").alias("ts"),
        )
    )


def events_as_messages(events: DataFrame) -> DataFrame:
    """The same ticks as JSON wire messages in a binary ``value`` column."""
    message = F.to_json(
        F.struct(
            F.col("event_type").alias("ticker"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").try_cast("int").alias("volume"),
            (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("timestamp"),
        )
    )
    return events.select(message.cast("binary").alias("value"))
