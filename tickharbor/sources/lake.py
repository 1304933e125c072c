"""Scans of Parquet tick tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import with_time_partitions
from ..functions.partitions import Spec, Specs, as_specs, hour_key, hour_key_of, partition_predicate
from ..schema import BATCH_COL, LAKE_SCHEMA, PARTITION_COLS, TICK_SCHEMA
from .commits import RUN_COL, PublishedBatches, compacted_hours, folders_of, published_batches
from .paths import matching


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_ticks(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a whole table; Hive directories become partition columns.

    Passing the schema (partition columns included) saves the job that reads a footer to infer it.
    The directories of a stream's batches and of compaction runs are no columns; batches and runs that are
    not published are not seen (``commits``).
    """
    hours = compacted_hours(spark, base)
    if hours is not None:
        return read_hours(spark, base, hours, schema)
    seen = published_batches(spark, base)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return only_published(reader.parquet(base), seen).drop(BATCH_COL)


def read_hours(spark: SparkSession, base: str, hours: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Scan some of a root's ``compacted_hours``; only their directories are listed."""
    folders = folders_of(hours, base)
    if not folders:
        return spark.createDataFrame([], schema or LAKE_SCHEMA)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", base).parquet(*folders).drop(RUN_COL)


def only_published(table: DataFrame, seen: PublishedBatches | None) -> DataFrame:
    """Without the directories of batches that did not count when ``seen`` was read, before the listing."""
    return table if seen is None or BATCH_COL not in table.columns else table.where(seen.visible())


def read_partitions(
    spark: SparkSession,
    base: str,
    specs: Specs,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan only the directories that the specs select.

    Only those are listed, if each spec begins with the outermost columns (year; year and month; ...).
    """
    chosen = as_specs(specs)
    hours = compacted_hours(spark, base)
    if hours is not None:
        return read_hours(spark, base, hours.where(partition_predicate(chosen)), schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return load_partitions(spark, reader.format("parquet"), base, chosen).drop(BATCH_COL)


def load_partitions(spark: SparkSession, reader: DataFrameReader, base: str, specs: list[Spec]) -> DataFrame:
    """What the specs select of the published part of a root that is not compacted, in any file format."""
    seen = published_batches(spark, base)
    folders = _folders(spark, base, specs)
    table = reader.option("basePath", base).load(folders) if folders else reader.load(base)
    return only_published(table, seen).where(partition_predicate(specs))


def _folders(spark: SparkSession, base: str, specs: list[Spec]) -> list[str]:
    """The directories to open; none if that takes the whole root, or if there are none."""
    # What lies within another spec would be listed, and read, twice.
    widest = [s for s in specs if not any(t.items() < s.items() for t in specs)]
    found: set[str] = set()
    for spec in widest:
        names = PARTITION_COLS[: len(spec)]
        if not spec or set(names) != set(spec):
            return []
        # Zeros in front of a number make no difference to its meaning.
        steps = [f"{name}={{{spec[name]},{spec[name]:02d}}}" for name in names]
        found.update(matching(spark, "/".join([base, *steps])))
    return sorted(found)


def read_legacy_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Read an old unpartitioned table, which keeps epoch seconds, in the current column layout."""
    return with_time_partitions(spark.read.schema(TICK_SCHEMA).parquet(path))


def union_ticks(*tables: DataFrame) -> DataFrame:
    """Concatenate by column name; a column that a table lacks is NULL for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def ticks_since(ticks: DataFrame, since: dt.datetime | str | Column) -> DataFrame:
    """Rows with ``ts >= since``; text and naive datetimes are read in the session zone.

    On a lake table the bound is also stated on the partition columns, so older directories
    are never listed for reading; the rest of the bound reaches the Parquet reader.
    """
    if isinstance(since, dt.datetime) and since.tzinfo is None:
        since = since.isoformat(" ")
    bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
    condition = F.col("ts") >= bound
    if {"year", "month", "day", "hour"} <= set(ticks.columns):
        condition = condition & (hour_key() >= hour_key_of(bound))
    return ticks.where(condition)
