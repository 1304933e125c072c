"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BATCH_COL, INVENTORY_SCHEMA, LAKE_SCHEMA
from .commits import RUN_COL
from .lake import path_is_missing
from .newest import newest_files_by_name

# Fixed value: a file counts as Parquet by its suffix, in any letter case.
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"


def file_inventory(spark: SparkSession, base: str, min_size: int = 0) -> DataFrame:
    """Every Parquet file below ``base`` with its size and modification time.

    The suffix is applied while listing and the file bodies are never opened. Names that start
    with ``_`` or ``.`` and files of zero bytes are invisible, as everywhere in Spark; files of batches that are not
    published are there, and listed. A missing root lists no files.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
    )
    try:
        listing = reader.load(base)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    files = listing.select(
        F.col("path").alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
    return files.where(F.col("size") >= min_size) if min_size > 0 else files


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Load a snapshot written by ``save_inventory`` or ``keep_snapshot``; of a folder of kept ones, the newest."""
    rows = spark.read.parquet(path)
    if "snapshot" in rows.columns:
        newest = rows.agg(F.max_by("snapshot", "snapshot_at").alias("snapshot")).first().snapshot
        rows = rows.where(F.col("snapshot") == newest).drop("snapshot")
    return rows.where("key IS NOT NULL")


def read_latest_files(
    spark: SparkSession,
    base: str,
    n: int = 1,
    by: str = "mtime",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read the ``n`` newest files of a table.

    ``by="mtime"``: newest modification time first, empty files skipped, an error if there are
    none. ``by="name"``: highest hour directory first (as numbers), then file name, found without
    listing older directories; no files give an empty DataFrame. Only the ``n`` chosen paths pass through the
    driver; files are combined by column name.
    """
    if by == "mtime":
        newest = file_inventory(spark, base, min_size=1).orderBy(F.desc("last_modified"), F.desc("key"))
        paths = [row.key for row in newest.select("key").limit(n).collect()]
    elif by == "name":
        paths = newest_files_by_name(spark, base, n)
    else:
        raise ValueError(f"by must be 'mtime' or 'name', not {by!r}")
    if not paths:
        if by == "mtime":
            raise FileNotFoundError(f"no non-empty Parquet file below {base}")
        return spark.createDataFrame([], schema or LAKE_SCHEMA)
    reader = spark.read.option("basePath", base).option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths).drop(BATCH_COL, RUN_COL)
