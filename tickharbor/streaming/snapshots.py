"""A small result that every micro-batch replaces.

Each batch has a folder of its own, so a repeated batch rewrites only that. Readers open the newest
folder that is complete, by path: the batch at work is never looked at, and the last ``KEPT`` ones
stay for readers that have begun.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.lake import path_is_missing
from ..sources.paths import matching, remove_folder

KEPT = 8


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def _batches(spark: SparkSession, pattern: str) -> list[int]:
    """The batches whose folders a pattern, or a file in each of them, names."""
    return sorted(int(found.split("/batch=")[-1].split("/")[0]) for found in matching(spark, pattern))


def write_snapshot(result: DataFrame, path: str, batch_id: int) -> None:
    """Keep the result of a batch, and drop those more than ``KEPT`` batches older."""
    spark = result.sparkSession
    result.write.mode("overwrite").parquet(_folder(path, batch_id))
    for old in _batches(spark, f"{path}/batch=*"):
        if old <= batch_id - KEPT:
            remove_folder(spark, _folder(path, old))


def read_snapshot(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The result of one batch; no rows if that batch left none."""
    try:
        return spark.read.schema(schema).parquet(_folder(path, batch_id))
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def read_newest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The result of the newest batch that is complete."""
    complete = _batches(spark, f"{path}/batch=*/_SUCCESS")
    if not complete:
        raise FileNotFoundError(f"no complete snapshot below {path}")
    return spark.read.parquet(_folder(path, complete[-1]))
