"""Data tests. Each returns what violates the rule, so no rows means the test passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EVENT_TIME_CANDIDATES


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """The rows in which ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts; NULLs do not count as duplicates."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_ticks(df: DataFrame) -> DataFrame:
    """One row per requirement of the serving layer: ``(check, passed)``.

    The row checks look at one partition after the other and stop at the first row they find.
    """
    has_ticker = "ticker" in df.columns
    checks = {
        "ticker_column": has_ticker,
        "event_time_column": any(name in df.columns for name in EVENT_TIME_CANDIDATES),
        "has_rows": not df.isEmpty(),
        "has_tickers": has_ticker and not df.where(F.col("ticker").isNotNull()).isEmpty(),
    }
    return df.sparkSession.createDataFrame(list(checks.items()), "check string, passed boolean")
