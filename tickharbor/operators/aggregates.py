"""Grouped statistics.

Every operator is a partial plus final hash aggregate: a task ships one row per group however
many rows the group has, so a ticker that holds a third of the table costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PARTITION_COLS


def _price_stats() -> list:
    return [
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ]


def ticker_summary(ticks: DataFrame) -> DataFrame:
    """Row count and average, lowest and highest price per ticker, highest average first."""
    return (
        ticks.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("total_records"), *_price_stats())
        .orderBy(F.desc("avg_price"))
    )


def avg_price_by_ticker(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker").agg(F.avg("price").alias("avg_price"))


def avg_price_by_hour_ticker(ticks: DataFrame) -> DataFrame:
    """Average per hour of day and ticker, pooled over all days."""
    return (
        ticks.groupBy("hour", "ticker")
        .agg(F.avg("price").alias("avg_price"))
        .orderBy("hour", "ticker")
    )


def record_count_by_ticker(ticks: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per ticker, largest first; ``top`` keeps the first few (ties by ticker name)."""
    counts = (
        ticks.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("num_records"))
        .orderBy(F.desc("num_records"), "ticker")
    )
    return counts if top is None else counts.limit(top)


def daily_avg_price(ticks: DataFrame, ticker: str) -> DataFrame:
    """Average price per day of one ticker; the equality reaches the Parquet reader."""
    return (
        ticks.where(F.col("ticker") == ticker)
        .groupBy(F.to_date("ts").alias("dt"))
        .agg(F.avg("price").alias("avg_price"))
        .orderBy("dt")
    )


def price_trend(ticks: DataFrame) -> DataFrame:
    """Mean price per ticker and instant; rows without either key are left out.

    The result is about as large as the input, so it is not sorted globally.
    """
    return (
        ticks.where(F.col("ticker").isNotNull() & F.col("ts").isNotNull())
        .groupBy("ticker", "ts")
        .agg(F.avg("price").alias("price"))
    )


def ticker_kpis(ticks: DataFrame, ticker: str | None = None) -> DataFrame:
    """Lowest, highest and average price, of one ticker or of all at once."""
    chosen = ticks if ticker is None else ticks.where(F.col("ticker") == ticker)
    return chosen.groupBy("ticker").agg(*_price_stats())


def ticker_list(ticks: DataFrame, keep_null: bool = False) -> DataFrame:
    """The distinct tickers."""
    tickers = ticks.select("ticker")
    return (tickers if keep_null else tickers.where(F.col("ticker").isNotNull())).distinct()


def tick_count(ticks: DataFrame) -> DataFrame:
    """One row: the number of rows and whether there are none."""
    return ticks.agg(F.count(F.lit(1)).alias("total_records")).withColumn(
        "is_empty", F.col("total_records") == 0
    )


def ticks_by_partition(ticks: DataFrame) -> DataFrame:
    """Rows per hour directory; on a lake table this reads file footers only."""
    return ticks.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("total_records"))
