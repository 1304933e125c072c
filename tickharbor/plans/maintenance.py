"""Jobs over the raw and compacted roots."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import ALL_HOURS, Specs, as_specs, hour_key, partition_predicate
from ..operators.compaction import MAX_FILE_BYTES, fingerprints, listed_files, run_compaction
from ..operators.history import keep_snapshot, read_snapshot
from ..operators.inventory import assert_compaction, require_compaction
from ..schema import LAKE_SCHEMA, PARTITION_COLS
from ..scratch import stage
from ..sources.commits import compacted_hours
from ..sources.lake import read_hours, read_partitions, read_ticks


@dataclass(frozen=True)
class VerifiedCompaction:
    """What a verified run did: the report, the two file inventories and the missed targets."""

    report: DataFrame
    before: DataFrame
    after: DataFrame
    failures: DataFrame

    def require(self) -> None:
        """Raise unless every selected hour was compacted and met its target."""
        unfinished = self.report.where(F.col("status") != "compacted")
        require_compaction(unfinished.select("partition", "status", "message"))
        require_compaction(self.failures)


def compact_and_verify(
    spark: SparkSession,
    raw: str,
    compacted: str,
    specs: Specs,
    snapshots: str,
    num_files: int = 1,
    max_file_bytes: int = MAX_FILE_BYTES,
    min_pct: float = 0.0,
    per_partition: bool = False,
    strict: bool = False,
    schema: T.StructType = LAKE_SCHEMA,
    raise_on_failure: bool = True,
) -> VerifiedCompaction:
    """Compact the selected hours, keep file snapshots from before and after, and check them.

    The snapshots, each in a folder of its own below ``snapshots/before`` and ``snapshots/after``, cover the files that were compacted and the files
    they became, so what the stream adds meanwhile does not disturb the comparison. Row counts
    must agree in every case; the file-count target is that of ``assert_compaction``.
    """
    run = run_compaction(spark, raw, compacted, specs, num_files, max_file_bytes, schema)
    before = _snapshot(spark, run.before, raw, f"{snapshots}/before")
    after = _snapshot(spark, run.after, compacted, f"{snapshots}/after")
    failures = assert_compaction(before, after, min_pct, per_partition, strict)
    done = VerifiedCompaction(run.report, before, after, failures)
    if raise_on_failure:
        done.require()
    return done


def _snapshot(spark: SparkSession, files: DataFrame, root: str, path: str) -> DataFrame:
    return read_snapshot(spark, keep_snapshot(files, path, root))


_SOURCE = ["source_files", "source_bytes", "source_hash"]


def selected_hours(hours: DataFrame | None, specs: Specs | None) -> DataFrame | None:
    return hours if hours is None or specs is None else hours.where(partition_predicate(as_specs(specs)))


def changed_hours(spark: SparkSession, raw: str, compacted: DataFrame | None, specs: Specs | None) -> DataFrame:
    """``hour_key, compacted_rows`` of the raw hours whose files are not those that were compacted.

    Raw is listed, and nothing of either root is opened: the files of a compacted hour are known by number, size
    and digest.
    """
    files = listed_files(spark, raw, ALL_HOURS if specs is None else specs)
    now = fingerprints(files).withColumn("hour_key", hour_key()).drop(*PARTITION_COLS)
    if compacted is None:
        return stage(now.select("hour_key", F.lit(0).cast("bigint").alias("compacted_rows")), "open-hours")
    names = {name: f"known_{name}" for name in _SOURCE}
    known = compacted.select(hour_key().alias("hour_key"), "rows", *_SOURCE).withColumnsRenamed(names)
    same = reduce(and_, [F.col(name) == F.col(known_name) for name, known_name in names.items()])
    changed = now.join(known, "hour_key", "left").where(~F.coalesce(same, F.lit(False)))
    return stage(changed.select("hour_key", F.coalesce("rows", F.lit(0)).alias("compacted_rows")), "open-hours")


def read_raw(spark: SparkSession, raw: str, specs: Specs | None, schema: T.StructType) -> DataFrame:
    table = read_ticks(spark, raw, schema) if specs is None else read_partitions(spark, raw, specs, schema)
    return table.withColumn("hour_key", hour_key())


def tick_view(
    spark: SparkSession,
    raw: str,
    compacted: str,
    specs: Specs | None = None,
    schema: T.StructType = LAKE_SCHEMA,
) -> DataFrame:
    """Every row: compacted hours, and raw for the hours whose compacted copy is missing or out of date.

    The hours that live in raw are staged first: one row each, and small, since only hours behind
    the last compaction, and those with late rows, are in it. The semi join on them prunes the other
    raw directories at run time; of the compacted root only the current hours are opened at all. Which they are
    is told by listing raw, without opening a file.

    ``specs`` narrows the view to some partitions, and with it the listing.
    """
    hours = selected_hours(compacted_hours(spark, compacted), specs)
    # The filter, which all hours pass, lets the join prune directories.
    open_hours = changed_hours(spark, raw, hours, specs).where("hour_key >= -1").select("hour_key")
    still_raw = read_raw(spark, raw, specs, schema).join(open_hours, "hour_key", "left_semi").drop("hour_key")
    if hours is None:
        return still_raw
    current = hours.withColumn("hour_key", hour_key()).join(open_hours, "hour_key", "left_anti")
    return read_hours(spark, compacted, current, schema).unionByName(still_raw)


def hours_needing_compaction(
    spark: SparkSession,
    raw: str,
    compacted: str,
    specs: Specs | None = None,
    schema: T.StructType = LAKE_SCHEMA,
) -> DataFrame:
    """Raw hours (of ``specs``, or all) whose row count differs from that of their compacted copy.

    Rows without a time are one more hour, of NULLs, which only the spec ``all`` selects.
    """
    changed = changed_hours(spark, raw, selected_hours(compacted_hours(spark, compacted), specs), specs)
    # Only the files of hours that have changed are opened, and of those the footers.
    rows = read_raw(spark, raw, specs, schema).join(changed.where("hour_key >= -1"), "hour_key", "left_semi")
    counted = rows.groupBy("hour_key").agg(F.count(F.lit(1)).alias("raw_rows"))
    key = F.col("hour_key")
    stale = counted.join(changed, "hour_key").where("raw_rows <> compacted_rows")
    stale = stale.withColumn("hour_key", F.when(key >= 0, key))
    return stale.select(
        F.floor(key / 1_000_000).cast("int").alias("year"),
        F.pmod(F.floor(key / 10_000), F.lit(100)).cast("int").alias("month"),
        F.pmod(F.floor(key / 100), F.lit(100)).cast("int").alias("day"),
        F.pmod(key, F.lit(100)).cast("int").alias("hour"),
        "raw_rows",
        "compacted_rows",
    )
