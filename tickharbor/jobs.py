"""Entry points for spark-submit: ``python -m tickharbor.jobs <job> --help``."""

from __future__ import annotations

import argparse
import datetime as dt
import time

from pyspark.sql import SparkSession

from . import operators as ops
from .functions import partition_spec_for
from .operators.compaction import MAX_FILE_BYTES
from .plans.maintenance import compact_and_verify, tick_view
from .session import build_session
from .sources import file_inventory, read_inventory, read_ticks, tick_source
from .streaming import ingest_ticks
from .streaming.ingest import TRIGGER


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Kafka to the raw root and the quarantine, until stopped."""
    messages = tick_source(
        spark,
        bootstrap=args.bootstrap,
        topic=args.topic,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets,
        fail_on_data_loss=not args.allow_data_loss,
    )
    ingest_ticks(
        messages, args.raw, args.quarantine, args.checkpoints, trigger=args.trigger, spread=args.spread
    )
    spark.streams.awaitAnyTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Compact the selected hours, or those of the run's day; fail if the result misses its target."""
    done = compact_and_verify(
        spark,
        args.raw,
        args.compacted,
        args.partitions or partition_spec_for(args.run_date or dt.datetime.now(dt.timezone.utc)),
        args.snapshots,
        num_files=args.num_files,
        max_file_bytes=args.max_file_bytes,
        min_pct=args.min_reduction_pct,
        per_partition=args.per_partition,
        strict=args.strict,
        raise_on_failure=False,
    )
    if args.report:
        ops.save_table(done.report, f"{args.report}/report")
        ops.save_table(done.failures, f"{args.report}/failures")
    done.report.show(100, truncate=False)
    done.require()


def summary(spark: SparkSession, args: argparse.Namespace) -> None:
    """Per-ticker summary of the merged view; kept below ``--out`` if that is given."""
    result = ops.ticker_summary(tick_view(spark, args.raw, args.compacted))
    if args.out:
        ops.save_table(result, args.out)
        result = read_ticks(spark, args.out)
    result.show(truncate=False)


def latest(spark: SparkSession, args: argparse.Namespace) -> None:
    """The newest rows, again and again."""
    while True:
        ops.latest_ticks_at(spark, args.raw, args.n).show(truncate=False)
        time.sleep(args.every)


def inventory(spark: SparkSession, args: argparse.Namespace) -> None:
    """Totals, groups and largest files below a root; a snapshot is kept if ``--out`` is given."""
    files = file_inventory(spark, args.root)
    if args.out:
        ops.save_inventory(files, args.out, args.root)
        files = read_inventory(spark, args.out)
    ops.inventory_summary(files).show()
    ops.inventory_by_group(files, args.root).show(truncate=False)
    ops.largest_files(files, args.show_top).show(truncate=False)


def diff(spark: SparkSession, args: argparse.Namespace) -> None:
    """What changed between two kept inventories; every key is kept below ``--out`` if that is given."""
    changes = ops.inventory_diff(read_inventory(spark, args.a), read_inventory(spark, args.b))
    if args.out:
        ops.save_table(changes, args.out)
        changes = spark.read.schema(changes.schema).parquet(args.out)
    changes.groupBy("change").count().show()
    changes.orderBy("change", "key").show(args.show, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickharbor.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    sub = job(ingest, "bootstrap", "raw", "quarantine", "checkpoints")
    sub.add_argument("--topic", default="stock-ticks")
    sub.add_argument("--allow-data-loss", action="store_true")
    sub.add_argument("--starting-offsets", default="latest")
    sub.add_argument("--max-offsets", type=int, help="most messages of a batch")
    sub.add_argument("--trigger", default=TRIGGER)
    sub.add_argument("--spread", type=int, help="tasks that share an hour of a backfill")
    sub = job(compact, "raw", "compacted", "snapshots")
    sub.add_argument("--partitions", help="hours to compact; without it, those of the run's day")
    sub.add_argument("--run-date", type=dt.date.fromisoformat, help="the run's day, if not today in UTC")
    sub.add_argument("--num-files", type=int, default=1)
    sub.add_argument("--max-file-bytes", type=int, default=MAX_FILE_BYTES)
    sub.add_argument("--report", help="where to keep the report and the failures")
    sub.add_argument("--min-reduction-pct", type=float, default=0.0)
    sub.add_argument("--per-partition", action="store_true")
    sub.add_argument("--strict", action="store_true")
    job(summary, "raw", "compacted").add_argument("--out")
    sub = job(latest, "raw")
    sub.add_argument("--n", type=int, default=5)
    sub.add_argument("--every", type=float, default=5.0)
    sub = job(inventory, "root")
    sub.add_argument("--out")
    sub.add_argument("--show-top", type=int, default=5)
    sub = job(diff, "a", "b")
    sub.add_argument("--show", type=int, default=100)
    sub.add_argument("--out")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"tickharbor-{args.job}"), args)


if __name__ == "__main__":
    main()
