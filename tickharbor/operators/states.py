"""Mergeable states of price statistics.

A state is one row: how many ticks, how many prices, their sum, the lowest and the highest. States of disjoint
sets of ticks merge by sums, minima and maxima, so statistics can be answered from states that were kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a state, and how two of them merge.
_MERGE = {"n_ticks": F.sum, "n_prices": F.sum, "sum_price": F.sum, "min_price": F.min, "max_price": F.max}


def price_states(ticks: DataFrame, *keys: str) -> DataFrame:
    """One state per value of ``keys``; without a price the sum, minimum and maximum are NULL."""
    return ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.count("price").alias("n_prices"),
        F.sum("price").alias("sum_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def merge_states(states: DataFrame, *keys: str | Column) -> DataFrame:
    """States of a finer grouping as those of a coarser one."""
    return states.groupBy(*keys).agg(*[merge(name).alias(name) for name, merge in _MERGE.items()])


def _average() -> Column:
    return F.try_divide("sum_price", "n_prices").alias("avg_price")


def ticker_summary_of(states: DataFrame) -> DataFrame:
    """As ``ticker_summary``, from states."""
    merged = merge_states(states, "ticker")
    total = F.col("n_ticks").alias("total_records")
    return merged.select("ticker", total, _average(), "min_price", "max_price").orderBy(F.desc("avg_price"))


def ticker_kpis_of(states: DataFrame, ticker: str | None = None) -> DataFrame:
    """As ``ticker_kpis``, from states."""
    chosen = states if ticker is None else states.where(F.col("ticker") == ticker)
    return merge_states(chosen, "ticker").select("ticker", _average(), "min_price", "max_price")


def avg_price_by_hour_ticker_of(states: DataFrame) -> DataFrame:
    """As ``avg_price_by_hour_ticker``, from states with an ``hour``."""
    return merge_states(states, "hour", "ticker").select("hour", "ticker", _average()).orderBy("hour", "ticker")


def record_count_by_ticker_of(states: DataFrame, top: int | None = None) -> DataFrame:
    """As ``record_count_by_ticker``, from states."""
    counts = merge_states(states, "ticker").select("ticker", F.col("n_ticks").alias("num_records"))
    counts = counts.orderBy(F.desc("num_records"), "ticker")
    return counts if top is None else counts.limit(top)
