"""The newest part of a lake, found from the top: only directories on the way to it are listed.

Years are looked at from the highest number down, then the months of a year, its days and hours, and no further
than the answer needs. A compacted root has its hours in the newest version, and is not listed at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BATCH_COL, LAKE_SCHEMA, PARTITION_COLS
from .commits import RUN_COL, PublishedBatches, compacted_hours, hour_folder, published_batches
from .lake import only_published, path_is_missing, read_ticks
from .paths import children


def _levels(entries: Sequence[tuple[str, bool, int]], name: str) -> list[str]:
    """The folders of one partition column, highest number first; what is no number comes last."""
    found = [entry for entry, folder, _ in entries if folder and entry.startswith(f"{name}=")]
    value = {entry: entry.partition("=")[2] for entry in found}
    return sorted(found, key=lambda entry: int(value[entry]) if value[entry].isdigit() else -1, reverse=True)


def newest_hours(spark: SparkSession, root: str) -> Iterator[str]:
    """The hour directories of a root, newest first and rows without a time last, listed as they are asked for."""
    hours = compacted_hours(spark, root)
    if hours is not None:
        order = [F.desc_nulls_last(name) for name in PARTITION_COLS]
        for row in hours.select(*PARTITION_COLS, RUN_COL).orderBy(*order).toLocalIterator():
            yield hour_folder(root, row)
        return

    def below(folder: str, names: Sequence[str]) -> Iterator[str]:
        if not names:
            yield folder
            return
        for entry in _levels(children(spark, folder), names[0]):
            yield from below(f"{folder}/{entry}", names[1:])

    yield from below(root, PARTITION_COLS)


def read_newest(spark: SparkSession, root: str, n: int, schema: T.StructType = LAKE_SCHEMA) -> DataFrame:
    """Whole hours from the newest back, as many as hold ``n`` rows or all there are; no order among the rows.

    Each round opens four times as many hours as the one before, and counts up to ``n`` rows by footers.
    """
    seen = published_batches(spark, root)
    hours, taken, width = newest_hours(spark, root), [], 1
    table = spark.createDataFrame([], schema)
    while True:
        step = [hour for _, hour in zip(range(width), hours)]
        if not step:
            return table if taken else _unpartitioned(spark, root, schema)
        taken += step
        opened = spark.read.schema(schema).option("basePath", root).parquet(*taken)
        table = only_published(opened, seen).drop(BATCH_COL, RUN_COL)
        if table.limit(n).count() >= n:
            return table
        width *= 4


def _unpartitioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    try:
        return read_ticks(spark, root, schema)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def newest_files_by_name(spark: SparkSession, root: str, n: int) -> list[str]:
    """Paths of the last ``n`` Parquet files: highest hour first, then file name; empty files do not count.

    In each directory, files that are in none of its hours come after those that are.
    """
    seen = published_batches(spark, root)
    hours = compacted_hours(spark, root)
    found: list[str] = []
    if hours is not None:
        for folder in newest_hours(spark, root):
            found += _files(spark, folder, children(spark, folder), seen)
            if len(found) >= n:
                break
        return found[:n]

    def below(folder: str, names: Sequence[str]) -> None:
        entries = children(spark, folder)
        levels = _levels(entries, names[0]) if names else []
        for entry in levels:
            if len(found) < n:
                below(f"{folder}/{entry}", names[1:])
        if len(found) < n:
            found.extend(_files(spark, folder, [e for e in entries if e[0] not in levels], seen))

    below(root, PARTITION_COLS)
    return found[:n]


def _files(
    spark: SparkSession, folder: str, entries: Sequence[tuple[str, bool, int]], seen: PublishedBatches | None
) -> list[str]:
    """Parquet files at any depth, by falling name."""
    found: list[tuple[str, str]] = []
    for name, is_folder, size in entries:
        if name.startswith((".", "_")):
            continue
        if is_folder:
            attempt = name.partition("=")[2]
            if seen is None or not name.startswith(f"{BATCH_COL}=") or seen.counts(attempt):
                inside = _files(spark, f"{folder}/{name}", children(spark, f"{folder}/{name}"), seen)
                found += [(path.rpartition("/")[2], path) for path in inside]
        elif size and name.lower().endswith(".parquet"):
            found.append((name, f"{folder}/{name}"))
    return [path for _, path in sorted(found, reverse=True)]
