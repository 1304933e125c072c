"""Inventories over time: every snapshot kept, and each file's validity derived from them.

A snapshot has a folder of its own, so none replaces another. A file, that is a key with a size and a time of
change, is valid from the first snapshot that has it until the next one that lacks it; a file that vanishes and comes
back has an interval for each stay.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import stage
from .inventory import inventory_diff

_FILE = ("key", "size", "last_modified")


def _moment(at: dt.datetime | str | Column) -> Column:
    if isinstance(at, Column):
        return at
    if isinstance(at, dt.datetime) and at.tzinfo is None:
        at = at.isoformat(" ")
    return F.lit(at).cast("timestamp")


def keep_snapshot(
    inventory: DataFrame, root: str, base: str, taken_at: dt.datetime | str | None = None
) -> str:
    """Add a snapshot of ``inventory`` (``key, size, last_modified``) below ``root``; the folder it is in.

    A row without a key marks the snapshot itself, so that one of no files is known too.
    """
    spark = inventory.sparkSession
    at = _moment(taken_at or dt.datetime.now(dt.timezone.utc))
    files = inventory.select(F.col("key"), F.col("size").cast("bigint").alias("size"), F.col("last_modified").cast("timestamp").alias("last_modified"))
    marker = spark.range(1).select(*[F.lit(None).cast(kind).alias(name) for name, kind in files.dtypes])
    folder = f"{root}/snapshot={uuid.uuid4().hex}"
    files.unionByName(marker).withColumns({"snapshot_at": at, "base": F.lit(base)}).write.parquet(folder)
    return folder


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The files of one kept snapshot, as ``read_inventory`` gives them."""
    return spark.read.parquet(folder).where("key IS NOT NULL")


def file_history(spark: SparkSession, root: str) -> DataFrame:
    """``key, size, last_modified, valid_from, valid_to`` of every stay of every file; open ends are NULL.

    The snapshots are numbered by time, a number per snapshot; a stay is a run of consecutive numbers, found by
    how far they are ahead of the count of the file's own snapshots. Rows of a file meet in one task: as many as
    there are snapshots. Snapshots of one moment count as one.
    """
    rows = spark.read.parquet(root)
    times = rows.where("key IS NULL").select("snapshot_at").distinct()
    # One row per snapshot: the only sort that is not by file.
    order = Window.orderBy("snapshot_at")
    numbered = stage(
        times.select(
            "snapshot_at", F.row_number().over(order).alias("number"), F.lead("snapshot_at").over(order).alias("next_at")
        ),
        "snapshots",
    )
    seen = rows.where("key IS NOT NULL").select(*_FILE, "snapshot_at").distinct().join(numbered, "snapshot_at")
    stay = F.col("number") - F.row_number().over(Window.partitionBy(*_FILE).orderBy("number"))
    return (
        seen.withColumn("stay", stay)
        .groupBy(*_FILE, "stay")
        .agg(F.min("snapshot_at").alias("valid_from"), F.max_by("next_at", "number").alias("valid_to"))
        .drop("stay")
    )


def inventory_as_of(history: DataFrame, at: dt.datetime | str | Column) -> DataFrame:
    """The files that the last snapshot up to a time had; none before the first snapshot."""
    return history.where(_valid_at(at)).select(*_FILE)


def _valid_at(at: dt.datetime | str | Column) -> Column:
    moment = _moment(at)
    return (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))


def inventory_changes_between(
    history: DataFrame, a: dt.datetime | str | Column, b: dt.datetime | str | Column
) -> DataFrame:
    """``inventory_diff`` of two moments; files that are valid at both are left out before the join."""
    first, second = _valid_at(a), _valid_at(b)
    changed = history.where(first != second)
    return inventory_diff(changed.where(first), changed.where(second))
