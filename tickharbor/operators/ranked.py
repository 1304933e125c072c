"""Newest rows, per-ticker tails and reference bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LAKE_SCHEMA
from ..scratch import stage
from ..sources.lake import ticks_since
from ..sources.newest import read_newest
from .aggregates import ticker_kpis


def _newest_first(ticks: DataFrame) -> list[Column]:
    """Newest first; the remaining columns make the order total up to identical rows."""
    ties = [name for name in ("price", "volume") if name in ticks.columns]
    return [F.desc_nulls_last("ts"), F.col("ticker"), *[F.desc(name) for name in ties]]


def latest_ticks(ticks: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` rows: a top-k per task and one merge of those, never a full sort."""
    return ticks.orderBy(*_newest_first(ticks)).limit(n)


def latest_ticks_recent(
    ticks: DataFrame,
    n: int = 5,
    as_of: dt.datetime | None = None,
    reach: Sequence[dt.timedelta] = (
        dt.timedelta(hours=1),
        dt.timedelta(days=1),
        dt.timedelta(days=30),
    ),
) -> DataFrame:
    """:func:`latest_ticks` for a partitioned table that is polled often.

    Looks back from ``as_of`` by each reach in turn and stops as soon as ``n`` rows are inside,
    so a poll normally touches the newest hours only. There is no upper bound and the last
    resort is the whole table: the answer is the same as that of :func:`latest_ticks`.
    """
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    for span in reach:
        recent = ticks_since(ticks, as_of - span)
        if recent.limit(n).count() >= n:
            return latest_ticks(recent, n)
    return latest_ticks(ticks, n)


def latest_ticks_at(spark: SparkSession, root: str, n: int = 5, schema: T.StructType = LAKE_SCHEMA) -> DataFrame:
    """:func:`latest_ticks` of the lake at ``root``, for polls: days older than the answer are not even listed.

    Empty hours, however many, only make it look at older ones.
    """
    return latest_ticks(read_newest(spark, root, n, schema), n)


def preview(ticks: DataFrame, n: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` rows of the main columns: any rows, or the first of a given order."""
    chosen = ticks.orderBy(*order_by) if order_by else ticks
    return chosen.select("ticker", "price", "ts", "volume").limit(n)


def ticker_tail(
    ticks: DataFrame, n: int = 20, ticker: str | None = None, splits: int | None = None
) -> DataFrame:
    """The newest ``n`` rows of every ticker (or of one), with ``rank`` 1 for the newest.

    Two rounds. The first ranks within (ticker, split), where a split is a set of whole input
    tasks: every task sends at most ``n`` rows per ticker, and those of one ticker go to
    ``splits`` places (as many as there are shuffle partitions, if not given). The second ranks what
    is left, at most ``n * splits`` rows per ticker. A ticker with a third of all rows therefore never
    meets in one task; for ``n`` over 1,000 that takes the limit threshold of :func:`build_session`.
    """
    if splits is None:
        splits = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = ticks if ticker is None else ticks.where(F.col("ticker") == ticker)
    order = [F.desc_nulls_last("ts"), *_newest_first(ticks)[2:]]
    split = F.pmod(F.spark_partition_id(), F.lit(splits))
    per_split = (
        chosen.withColumn("_split", split)
        .withColumn("rank", F.row_number().over(Window.partitionBy("ticker", "_split").orderBy(*order)))
        .where(F.col("rank") <= n)
        .drop("_split")
    )
    return per_split.withColumn(
        "rank", F.row_number().over(Window.partitionBy("ticker").orderBy(*order))
    ).where(F.col("rank") <= n)


def price_bands(ticks: DataFrame) -> DataFrame:
    """Every row with the lowest, highest and average price of its ticker.

    A window over the whole ticker would put all its rows into one task. Here the bands are
    aggregated first and staged (one row per ticker), then joined back: as a broadcast when the
    staged files are small, else as a sort-merge join whose hot keys adaptive execution splits.
    """
    bands = stage(ticker_kpis(ticks), "price-bands").withColumnRenamed("ticker", "_band_ticker")
    return ticks.join(bands, F.col("ticker").eqNullSafe(F.col("_band_ticker")), "left").drop(
        "_band_ticker"
    )
