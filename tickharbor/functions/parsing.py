"""From wire messages to typed ticks, on batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EVENT_TIME_CANDIDATES, PARTITION_COLS, TICK_SCHEMA
from .times import event_time

_CORRUPT = "_corrupt"


def parse_ticks(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode JSON messages into the four tick columns.

    Every message yields a row: what cannot be parsed becomes NULL. Use
    :func:`split_bad_ticks` to keep such rows out of the lake.
    """
    tick = F.from_json(F.col(value_col).cast("string"), TICK_SCHEMA)
    return raw.select(tick.alias("tick")).select("tick.*")


def with_time_partitions(ticks: DataFrame) -> DataFrame:
    """Replace epoch-second ``timestamp`` by ``ts`` and derive the hour partition columns."""
    ts = event_time(F.col("timestamp"), ticks.schema["timestamp"].dataType)
    return add_partition_columns(
        ticks.select("ticker", "price", "volume", ts.alias("ts"))
    )


def add_partition_columns(ticks: DataFrame) -> DataFrame:
    """Append year, month, day and hour of ``ts``."""
    return ticks.withColumns(
        {
            name: part("ts")
            for name, part in zip(PARTITION_COLS, (F.year, F.month, F.dayofmonth, F.hour))
        }
    )


def split_bad_ticks(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Enforce the tick schema: ``(good ticks, quarantined messages)``.

    Each message goes to exactly one side. The quarantine keeps the message text and the first
    reason that applies: ``malformed`` (not a JSON object, or a field of the wrong type),
    ``no_ticker``, ``no_price`` (missing or NaN), ``no_time`` (missing or not a valid instant).
    """
    return split_judged(judge_messages(raw, value_col))


def judge_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``message, tick, reason`` of every message; no reason for the good ones."""
    text = F.col(value_col).cast("string")
    checked_schema = T.StructType([*TICK_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    tick = F.from_json(text, checked_schema, {"columnNameOfCorruptRecord": _CORRUPT})
    # The one-element explode keeps the optimizer from copying the JSON parser into every use
    # of a field: each message is parsed once.
    parsed = raw.select(text.alias("message"), F.explode(F.array(tick)).alias("tick"))

    ts = event_time(F.col("tick.timestamp"), T.DoubleType())
    reason = (
        F.when(F.col("tick").isNull() | F.col(f"tick.{_CORRUPT}").isNotNull(), "malformed")
        .when(F.col("tick.ticker").isNull(), "no_ticker")
        .when(F.col("tick.price").isNull() | F.isnan("tick.price"), "no_price")
        .when(ts.isNull(), "no_time")
    )
    return parsed.withColumn("reason", reason)


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`split_bad_ticks`."""
    good = judged.where(F.col("reason").isNull()).select(
        *[F.col(f"tick.{name}").alias(name) for name in TICK_SCHEMA.fieldNames()]
    )
    bad = judged.where(F.col("reason").isNotNull()).select("message", "reason")
    return good, bad


def normalize_event_time(
    df: DataFrame,
    name: str = "ts",
    candidates: Sequence[str] = EVENT_TIME_CANDIDATES,
) -> DataFrame:
    """Find the event-time column, convert it to a timestamp and call it ``name``.

    The first existing candidate wins; a different column already called ``name`` is dropped.
    """
    source = next((c for c in candidates if c in df.columns), None)
    if source is None:
        raise ValueError(f"no event-time column: expected one of {list(candidates)}, got {df.columns}")
    converted = event_time(F.col(source), df.schema[source].dataType)
    return df.select(
        *[
            converted.alias(name) if column == source else F.col(column)
            for column in df.columns
            if column == source or column != name
        ]
    )
