"""A rollup of the compacted root: price states per hour and ticker, kept beside it.

The rows of a compacted hour never change within the run that wrote it, so the states of (hour, run) hold for ever:
an hour that is compacted again has a new run, and its old states no longer count. Readers take the states
of the current runs, and aggregate only the rest: hours compacted since the last update, and raw for those that
are open. ``_versions/<number>`` of the rollup's root names, for each run, the folder that holds its
states; like compacted hours, an update is published whole by creating one small file exclusively.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import Specs, hour_key
from ..operators.states import price_states
from ..schema import LAKE_SCHEMA
from ..scratch import stage
from ..sources.commits import RUN_COL, compacted_hours, newest_version
from ..sources.lake import read_hours
from ..sources.paths import create_small, remove_folder
from .maintenance import changed_hours, read_raw, selected_hours

#: With more folders of states than this an update gathers them in one.
MAX_FOLDERS = 32

_RUNS_SCHEMA = f"{RUN_COL} bigint, folder string"
_STATES = (
    "hour_key bigint, ticker string, n_ticks bigint, n_prices bigint, sum_price double, min_price double, "
    "max_price double"
)
_KEYS = ["hour_key", RUN_COL, "folder"]


def rolled_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run, folder`` of the runs whose rows are kept below ``root``, as the newest version has them."""
    found = newest_version(spark, root)
    return spark.createDataFrame([], _RUNS_SCHEMA) if found is None else spark.read.schema(_RUNS_SCHEMA).json(found[1])


def _kept_schema(columns: str) -> str:
    return f"{columns}, {_RUNS_SCHEMA}"


def kept_rows(spark: SparkSession, root: str, hours: DataFrame, columns: str = _STATES) -> DataFrame:
    """What is kept of ``hours`` (``hour_key, run, folder``); only the folders that they name are opened."""
    folders = [f"{root}/{row.folder}" for row in hours.select("folder").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], _kept_schema(columns))
    return spark.read.schema(_kept_schema(columns)).parquet(*folders).join(hours.select(*_KEYS), _KEYS, "left_semi")


def _hour_states(ticks: DataFrame) -> DataFrame:
    return price_states(ticks.withColumn("hour_key", hour_key()), "hour_key", "ticker")


def update_rollup(
    spark: SparkSession,
    compacted: str,
    rollup: str,
    schema: T.StructType = LAKE_SCHEMA,
    max_folders: int = MAX_FOLDERS,
) -> int:
    """Keep the states of the compacted hours that have none yet; returns how many hours that were.

    Only those hours are read. States of runs that are no longer current are forgotten, and a folder without any
    others is deleted. An update that dies before it is published leaves a folder that nobody reads, and
    of two at a time both count.
    """
    return update_kept(spark, compacted, rollup, _hour_states, _STATES, ["hour_key", "ticker"], schema, max_folders)


def update_kept(
    spark: SparkSession,
    compacted: str,
    root: str,
    derive: Callable[[DataFrame], DataFrame],
    columns: str,
    order: list[str],
    schema: T.StructType,
    max_folders: int,
) -> int:
    """:func:`update_rollup` for any rows, of ``columns``, that ``derive`` makes of each hour by itself."""
    hours = compacted_hours(spark, compacted)
    if hours is None:
        return 0
    keyed = stage(hours.withColumn("hour_key", hour_key()), "rollup-hours")
    known = stage(rolled_runs(spark, root), "rolled-runs")
    todo = keyed.join(known, RUN_COL, "left_anti")
    n_todo = todo.count()
    if not n_todo:
        return 0
    folder = f"states-{uuid.uuid4().hex[:12]}"
    new = derive(read_hours(spark, compacted, todo, schema)).join(todo.select("hour_key", RUN_COL), "hour_key")
    runs = todo.select(RUN_COL)
    if known.select("folder").distinct().count() >= max_folders:
        old = kept_rows(spark, root, keyed.join(known, RUN_COL), columns).drop("folder")
        new, runs = new.unionByName(old), keyed.select(RUN_COL)
    rows = new.withColumn("folder", F.lit(folder)).selectExpr(*[part.split()[0] for part in _kept_schema(columns).split(", ")])
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{root}/{folder}")
    _publish(spark, root, stage(runs.distinct().withColumn("folder", F.lit(folder)), "new-runs"), keyed)
    return n_todo


def _publish(spark: SparkSession, rollup: str, runs: DataFrame, current: DataFrame) -> None:
    """Add ``runs`` to what is known, less the runs that hold no ``current`` hour any more."""
    versions = f"{rollup}/_versions"
    while True:
        found = newest_version(spark, rollup)
        known = rolled_runs(spark, rollup).join(runs, RUN_COL, "left_anti")
        newest = current.agg(F.max(RUN_COL)).first()[0]
        # A run above all that this update has seen was rolled up by a later one.
        alive = known.join(current, RUN_COL, "left_semi").unionByName(known.where(F.col(RUN_COL) > newest))
        table = f"runs-{uuid.uuid4().hex[:12]}"
        alive.distinct().unionByName(runs).coalesce(1).write.json(f"{versions}/{table}")
        number = 1 if found is None else found[0] + 1
        if create_small(spark, f"{versions}/{number:012d}", table):
            break
        remove_folder(spark, f"{versions}/{table}")
    if found is not None:
        before = spark.read.schema(_RUNS_SCHEMA).json(found[1]).select("folder")
        for row in before.join(rolled_runs(spark, rollup), "folder", "left_anti").distinct().collect():
            remove_folder(spark, f"{rollup}/{row.folder}")
        remove_folder(spark, found[1])
        remove_folder(spark, f"{versions}/{found[0]:012d}")


def lake_states(
    spark: SparkSession,
    raw: str,
    compacted: str,
    rollup: str,
    specs: Specs | None = None,
    schema: T.StructType = LAKE_SCHEMA,
) -> DataFrame:
    """States of every tick that ``tick_view`` shows: ``hour_key, hour, ticker`` and the state's columns.

    Compacted hours that are up to date and rolled up are not scanned: their states are. Other compacted hours, and
    raw for the hours that are open, are aggregated here. Rows without a time have the key -1 and no hour.
    """
    hours = selected_hours(compacted_hours(spark, compacted), specs)
    open_hours = changed_hours(spark, raw, hours, specs).where("hour_key >= -1").select("hour_key")
    live = read_raw(spark, raw, specs, schema).join(open_hours, "hour_key", "left_semi")
    states = _hour_states(live.drop("hour_key"))
    if hours is not None:
        current = hours.withColumn("hour_key", hour_key()).join(open_hours, "hour_key", "left_anti")
        dealt = stage(current.join(rolled_runs(spark, rollup), RUN_COL, "left"), "rollup-hours")
        rolled, others = dealt.where("folder IS NOT NULL"), dealt.where("folder IS NULL")
        states = states.unionByName(kept_rows(spark, rollup, rolled).select(*states.columns))
        if not others.isEmpty():
            states = states.unionByName(_hour_states(read_hours(spark, compacted, others, schema)))
    hour = F.when(F.col("hour_key") >= 0, F.pmod("hour_key", F.lit(100))).cast("int").alias("hour")
    return states.select("hour_key", hour, "ticker", *[c for c in states.columns if c not in ("hour_key", "ticker")])
