"""Intermediate tables in the folder that all executors share.

A table written there survives the loss of executors, cuts the lineage, and gives the planner
the real size of what was computed: a join with a staged table is broadcast only if its files
are below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tickharbor-")
    return _local_dirs[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, never handed out before, below the shared folder."""
    return f"{shared_dir(spark)}/tickharbor/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
