"""Session construction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Hour partitions are cut in the session zone, so every job must agree on one.
SESSION_ZONE = "UTC"

_DEFAULTS = {
    "spark.sql.session.timeZone": SESSION_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps a 100 TB scan at about half a gigabyte per task, and the listing of millions of small
    # files from becoming millions of tasks.
    "spark.sql.files.maxPartitionNum": "200000",
    # Rank limits are applied before the shuffle for tails of any length.
    "spark.sql.optimizer.windowGroupLimitThreshold": str((1 << 31) - 1),
    # Window state for many tickers outgrows the heap-based store.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "tickharbor",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    Object-store endpoints and credentials are ordinary ``spark.hadoop.*`` settings: put them
    in ``spark-defaults.conf`` or pass them in ``conf``; none are built in. The library's own
    settings hold only where neither these nor ``spark-submit --conf`` say otherwise.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in _DEFAULTS.items():
        if key not in (conf or {}) and not given.contains(key):
            spark.conf.set(key, value)
    return spark


def pin_zone(spark: SparkSession) -> SparkSession:
    """Fix the session zone of a session that somebody else created."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark
