"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Options of Spark's file committer. What is written counts only when it is published, so tasks
# may move their own files and nothing is left for the driver to move.
PLACED_BY_TASKS = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}

# Options of Hadoop's local file system; other file systems do not read them. By default it writes a
# checksum file beside each file, and without native libraries starts a ``chmod`` process for either: more work than
# a small Parquet file itself, whose pages have checksums of their own.
WITHOUT_SIDE_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


def gather_partitions(df: DataFrame, partition_cols: Sequence[str], spread: int) -> DataFrame:
    """Bring the rows of a partition into at most ``spread`` tasks before a partitioned write.

    Without this every task opens a file in every directory it has rows for. The rows of one
    partition are divided by the task they come from, so a partition with a third of all rows
    still goes to ``spread`` tasks, and a task that is run again divides its rows as before.
    """
    share = F.pmod(F.spark_partition_id(), F.lit(spread))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *partition_cols, share)


def save_table(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
    spread: int | None = None,
) -> None:
    """Write a Parquet table, replacing what is there. Never write to a path that ``df`` reads."""
    if spread is not None:
        df = gather_partitions(df, partition_cols, spread)
    df.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def save_inventory(inventory: DataFrame, path: str, base: str) -> None:
    """Save a snapshot of a file inventory with the time it was taken and the listed root."""
    inventory.withColumns({"snapshot_at": F.current_timestamp(), "base": F.lit(base)}).write.mode(
        "overwrite"
    ).parquet(path)
