"""Every operator as a named query over the supplied tables.

Each query takes ``(spark, sf_dir)``. ``events`` is read as ticks, ``orders`` stands in for a
file inventory; lakes, streams and compactions are built from the ticks below the shared folder.
Results carry zone-free timestamps and averages rounded to six places, so that another engine
can be compared with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as ops
from .. import streaming
from ..functions import (
    normalize_event_time,
    parse_ticks,
    partition_spec_for,
    split_bad_ticks,
    with_time_partitions,
)
from ..functions.partitions import ALL_HOURS, hour_key
from ..operators import states as from_states
from ..operators.sinks import gather_partitions
from ..schema import LAKE_SCHEMA, PARTITION_COLS, TICK_SCHEMA
from ..scratch import scratch_path
from ..session import pin_zone
from ..sources import (
    events_as_messages,
    events_as_ticks,
    file_inventory,
    read_inventory,
    read_latest_files,
    read_legacy_ticks,
    read_partitions,
    read_ticks,
    tick_source,
    ticks_since,
    union_ticks,
)
from ..sources.commits import begin_batch
from ..streaming.batches import place_batch, write_batch
from ..streaming.snapshots import read_newest_snapshot
from .file_index import ticks_of as indexed_ticks
from .file_index import update_file_index
from .maintenance import compact_and_verify, hours_needing_compaction, tick_view
from .rollup import lake_states, update_rollup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; the comparison SQL uses the same ones.
TICKER = "purchase"
SINCE = dt.datetime(2024, 1, 20, 12, 30)
SPREAD = 32
RARE_SINCE = dt.datetime(2024, 1, 8, 6, 15)


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, with the session zone pinned and the result comparable."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(fn(pin_zone(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _comparable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if field.name in ("avg_price", "reduction_pct"):
            return F.round(column, 6).alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])


# ---- inputs -------------------------------------------------------------------------------


# The columns of the supplied tables. Stating them saves a footer-reading job per scan.
SCHEMAS = {
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ticks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_ticks(table(spark, sf_dir, "events"))


def drifting_messages(events: DataFrame) -> DataFrame:
    """One message per event, well-formed or damaged depending on the event.

    clicks: well-formed; purchases: ``NaN`` time if the value is over 10; views: price as text if
    over 10, else no price; signups: no ticker if over 10, else a fractional volume; errors: not JSON.
    """
    kind, high = F.col("event_type"), F.col("value") > 10
    price = F.col("value").cast("string")
    volume = F.get_json_object("props", "$.k")
    time = (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).cast("string")

    def message(ticker=kind, price=price, volume=volume, time=time):
        named = [
            F.concat(F.lit('"ticker":"'), ticker, F.lit('"')) if ticker is not None else None,
            F.concat(F.lit('"price":'), price) if price is not None else None,
            F.concat(F.lit('"volume":'), volume),
            F.concat(F.lit('"timestamp":'), time),
        ]
        return F.concat(
            F.lit("{"), F.concat_ws(",", *[n for n in named if n is not None]), F.lit("}")
        )

    text = (
        F.when(kind == "error", F.concat(F.lit("no tick at "), time))
        .when((kind == "purchase") & high, message(time=F.lit("NaN")))
        .when((kind == "view") & high, message(price=F.concat(F.lit('"'), price, F.lit('"'))))
        .when(kind == "view", message(price=None))
        .when((kind == "signup") & high, message(ticker=None))
        .when(kind == "signup", message(volume=F.concat(volume, F.lit(".5"))))
        .otherwise(message())
    )
    return events.select(text.cast("binary").alias("value"))


def orders_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an inventory: dated keys, low-priority ones outside any partition."""
    orders = table(spark, sf_dir, "orders")
    day = F.concat(
        F.lit("year="), F.year("o_orderdate").cast("string"),
        F.lit("/month="), F.month("o_orderdate").cast("string"),
        F.lit("/day="), F.dayofmonth("o_orderdate").cast("string"),
        F.lit("/"),
    )
    folder = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(day)
    return orders.select(
        F.concat(
            F.lit("tick-lake/"), folder, F.lit("part-"), F.col("o_orderkey").cast("string"),
            F.lit(".parquet"),
        ).alias("key"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        F.col("o_orderdate").cast("timestamp").alias("last_modified"),
        "o_orderstatus",
        "o_orderpriority",
    )


def files_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_as_files(spark, sf_dir).where(F.col("o_orderstatus") != "P")


def files_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = (F.col("o_orderstatus") == "F").cast("int")
    return (
        orders_as_files(spark, sf_dir)
        .where(F.col("o_orderpriority") != "1-URGENT")
        .withColumn("size", F.col("size") + grown)
    )


def files_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_as_files(spark, sf_dir).where(F.col("o_orderstatus") == "O")


_lakes: dict[tuple[str, str], str] = {}


def raw_lake(spark: SparkSession, sf_dir: str) -> str:
    """An hour-partitioned lake of all ticks, written once per application in three appends.

    Signups, then the rest, then the newest hour; one file per hour and append, however the input is split.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _lakes:
        path = scratch_path(spark, "raw")
        ticks = ticks_of(spark, sf_dir)
        newest = ticks.agg(F.max(hour_key()).alias("hour")).first().hour
        older, signup = hour_key() < newest, F.col("ticker") == "signup"
        for part in (older & signup, older & ~signup, hour_key() == newest):
            ops.save_table(ticks.where(part), path, PARTITION_COLS, mode="append", spread=1)
        _lakes[at] = path
    return _lakes[at]


def compacted_lake(spark: SparkSession, sf_dir: str) -> str:
    """The raw lake with every hour compacted into one file."""
    at = (spark.sparkContext.applicationId, f"{sf_dir}#compacted")
    if at not in _lakes:
        path = scratch_path(spark, "compacted")
        ops.compact_partitions(
            spark, raw_lake(spark, sf_dir), path, ALL_HOURS, raise_on_failure=True
        )
        _lakes[at] = path
    return _lakes[at]


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def finish(*running) -> None:
    for stream in running:
        stream.awaitTermination()


# ---- aggregates ---------------------------------------------------------------------------


@query
def ticker_summary(spark, sf_dir):
    return ops.ticker_summary(ticks_of(spark, sf_dir))


@query
def avg_price_by_ticker(spark, sf_dir):
    return ops.avg_price_by_ticker(ticks_of(spark, sf_dir))


@query
def avg_price_by_hour_ticker(spark, sf_dir):
    return ops.avg_price_by_hour_ticker(ticks_of(spark, sf_dir))


@query
def record_count_by_ticker(spark, sf_dir):
    return ops.record_count_by_ticker(ticks_of(spark, sf_dir))


@query
def top_tickers_by_count(spark, sf_dir):
    return ops.record_count_by_ticker(ticks_of(spark, sf_dir), top=3)


@query
def daily_avg_price(spark, sf_dir):
    return ops.daily_avg_price(ticks_of(spark, sf_dir), TICKER)


@query
def price_trend(spark, sf_dir):
    return ops.price_trend(ticks_of(spark, sf_dir)).withColumn("price", F.round("price", 6))


@query
def ticker_kpis(spark, sf_dir):
    return ops.ticker_kpis(ticks_of(spark, sf_dir))


@query
def ticker_kpis_selected(spark, sf_dir):
    return ops.ticker_kpis(ticks_of(spark, sf_dir), TICKER)


@query
def ticker_list(spark, sf_dir):
    return ops.ticker_list(ticks_of(spark, sf_dir))


@query
def ticker_list_with_null(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return ops.ticker_list(events_as_ticks(events.withColumn("event_type", kind)), keep_null=True)


@query
def tick_count(spark, sf_dir):
    return ops.tick_count(ticks_of(spark, sf_dir))


@query
def ticks_by_partition(spark, sf_dir):
    return ops.ticks_by_partition(ticks_of(spark, sf_dir))


# ---- newest rows, tails, bands --------------------------------------------------------------


@query
def latest_ticks(spark, sf_dir):
    return ops.latest_ticks(ticks_of(spark, sf_dir), 5)


@query
def latest_ticks_recent(spark, sf_dir):
    lake = read_ticks(spark, compacted_lake(spark, sf_dir), LAKE_SCHEMA)
    newest = ticks_of(spark, sf_dir).agg(F.unix_micros(F.max("ts")).alias("at")).first().at
    as_of = dt.datetime.fromtimestamp(newest / 1e6, dt.timezone.utc)
    return ops.latest_ticks_recent(lake, 5, as_of=as_of)


@query
def latest_ticks_by_path(spark, sf_dir):
    """The newest rows of the raw lake, searched from the newest hour down."""
    return ops.latest_ticks_at(spark, raw_lake(spark, sf_dir), 5)


@query
def ticker_tail(spark, sf_dir):
    return ops.ticker_tail(ticks_of(spark, sf_dir), 20)


@query
def ticker_tail_selected(spark, sf_dir):
    return ops.ticker_tail(ticks_of(spark, sf_dir), 20, TICKER)


@query
def ticker_tail_long(spark, sf_dir):
    return ops.ticker_tail(ticks_of(spark, sf_dir), 5_000)


@query
def price_bands(spark, sf_dir):
    return ops.price_bands(ticks_of(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return ops.preview(ticks_of(spark, sf_dir), 20, order_by=("ts", "ticker"))


# ---- parsing ------------------------------------------------------------------------------


@query
def parse_wire_messages(spark, sf_dir):
    return parse_ticks(events_as_messages(table(spark, sf_dir, "events")))


@query
def parse_drifting_messages(spark, sf_dir):
    """NaN times are reported as NULL here, since engines disagree on how NaN compares."""
    parsed = parse_ticks(drifting_messages(table(spark, sf_dir, "events")))
    return parsed.withColumn("timestamp", F.nanvl("timestamp", F.lit(None).cast("double")))


@query
def partition_wire_messages(spark, sf_dir):
    return with_time_partitions(parse_ticks(events_as_messages(table(spark, sf_dir, "events"))))


@query
def good_ticks(spark, sf_dir):
    return split_bad_ticks(drifting_messages(table(spark, sf_dir, "events")))[0]


@query
def quarantined_messages(spark, sf_dir):
    bad = split_bad_ticks(drifting_messages(table(spark, sf_dir, "events")))[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query
def normalize_epoch_time(spark, sf_dir):
    return normalize_event_time(parse_ticks(events_as_messages(table(spark, sf_dir, "events"))))


@query
def normalize_text_time(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("event_time")
    )
    return normalize_event_time(text)


@query
def union_tables_by_name(spark, sf_dir):
    """Current ticks and old ones, which keep epoch seconds and have no ``ts``."""
    events = table(spark, sf_dir, "events")
    current = ticks_of(spark, sf_dir).where(F.col("ticker") != "view").drop(*PARTITION_COLS)
    old = parse_ticks(events_as_messages(events.where(F.col("event_type") == "view")))
    return union_ticks(current, old)


@query
def legacy_table(spark, sf_dir):
    path = scratch_path(spark, "legacy")
    ops.save_table(parse_ticks(events_as_messages(table(spark, sf_dir, "events"))), path)
    return read_legacy_ticks(spark, path)


# ---- quality and models ---------------------------------------------------------------------


@query
def not_null_violations(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return ops.not_null_violations(labelled.select("doc_id", "quality"), "quality")


@query
def unique_violations(spark, sf_dir):
    return ops.unique_violations(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey")


@query
def check_ticks(spark, sf_dir):
    return ops.check_ticks(ticks_of(spark, sf_dir))


@query
def model_reference(spark, sf_dir):
    """A model kept as a view, and a second one that selects ``id = 1`` from it."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id")
    ops.materialize(ids, "event_ids")
    return ops.second_model(spark, "event_ids")


@query
def model_table(spark, sf_dir):
    """The same pair with the first model kept as a table."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    ops.materialize(ids, "order_ids", "table", scratch_path(spark, "model"))
    return ops.second_model(spark, "order_ids")


# ---- inventories ----------------------------------------------------------------------------


@query
def inventory_summary(spark, sf_dir):
    return ops.inventory_summary(orders_as_files(spark, sf_dir))


@query
def inventory_by_group(spark, sf_dir):
    return ops.inventory_by_group(orders_as_files(spark, sf_dir), prefix="tick-lake")


@query
def inventory_by_date_group(spark, sf_dir):
    dated = orders_as_files(spark, sf_dir).withColumn("key", F.regexp_replace("key", "year=199[0-5]", "date=199"))
    return ops.inventory_by_group(dated, prefix="tick-lake", accept_date=True)


@query
def inventory_by_partition(spark, sf_dir):
    return ops.inventory_by_partition(orders_as_files(spark, sf_dir))


@query
def largest_files(spark, sf_dir):
    return ops.largest_files(orders_as_files(spark, sf_dir), 5).select("key", "size")


@query
def inventory_diff(spark, sf_dir):
    return ops.inventory_diff(files_before(spark, sf_dir), files_after(spark, sf_dir))


@query
def inventory_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    files = orders_as_files(spark, sf_dir).select("key", "size", "last_modified")
    ops.save_inventory(files, path, base="tick-lake")
    return read_inventory(spark, path).drop("snapshot_at")


def kept_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of four daily snapshots; the last one has the files of the first again."""
    root = scratch_path(spark, "snapshots")
    for number, files in enumerate((files_before, files_after, files_kept, files_before), 1):
        ops.keep_snapshot(files(spark, sf_dir), root, "tick-lake", dt.datetime(2024, 1, number))
    return ops.file_history(spark, root)


@query
def file_history(spark, sf_dir):
    return kept_snapshots(spark, sf_dir).drop("last_modified")


@query
def inventory_as_of(spark, sf_dir):
    """The files at noon of the second day."""
    return ops.inventory_as_of(kept_snapshots(spark, sf_dir), dt.datetime(2024, 1, 2, 12)).select("key", "size")


@query
def inventory_changes_between(spark, sf_dir):
    """From the evening of the second day to the fourth."""
    return ops.inventory_changes_between(kept_snapshots(spark, sf_dir), "2024-01-02 20:00:00", "2024-01-04 00:00:00")


@query
def compaction_reduction(spark, sf_dir):
    return ops.compaction_reduction(files_before(spark, sf_dir), files_kept(spark, sf_dir))


@query
def compaction_reduction_by_day(spark, sf_dir):
    return ops.compaction_reduction(
        files_before(spark, sf_dir), files_kept(spark, sf_dir), per_partition=True
    )


@query
def compaction_check_by_day(spark, sf_dir):
    return ops.assert_compaction(
        files_before(spark, sf_dir), files_kept(spark, sf_dir), min_pct=50.0, per_partition=True
    )


@query
def compaction_check_strict(spark, sf_dir):
    return ops.assert_compaction(
        files_before(spark, sf_dir), files_kept(spark, sf_dir), per_partition=True, strict=True
    )


@query
def compaction_check_overall(spark, sf_dir):
    return ops.assert_compaction(files_before(spark, sf_dir), files_kept(spark, sf_dir), min_pct=75.0)


@query
def compaction_check_overall_strict(spark, sf_dir):
    """More files after than before: the strict target is missed."""
    return ops.assert_compaction(files_kept(spark, sf_dir), files_before(spark, sf_dir), strict=True)


# ---- lakes ------------------------------------------------------------------------------------


@query
def lake_scan(spark, sf_dir):
    return read_ticks(spark, raw_lake(spark, sf_dir))


@query
def lake_partitions(spark, sf_dir):
    specs = "year=2024,month=01,day=05;year=2024,month=1,day=7,hour=09"
    return read_partitions(spark, raw_lake(spark, sf_dir), specs, LAKE_SCHEMA)


@query
def run_day_ticks(spark, sf_dir):
    """The ticks that a run on a given day selects by default."""
    spec = partition_spec_for(dt.date(2024, 1, 9))
    return read_partitions(spark, raw_lake(spark, sf_dir), spec, LAKE_SCHEMA)


@query
def lake_since(spark, sf_dir):
    return ticks_since(read_ticks(spark, raw_lake(spark, sf_dir), LAKE_SCHEMA), SINCE)


@query
def lake_inventory(spark, sf_dir):
    return ops.inventory_by_partition(file_inventory(spark, raw_lake(spark, sf_dir), min_size=1))


@query
def newest_file(spark, sf_dir):
    return read_latest_files(spark, raw_lake(spark, sf_dir), 1, "mtime", LAKE_SCHEMA)


@query
def last_files_by_name(spark, sf_dir):
    return read_latest_files(spark, compacted_lake(spark, sf_dir), 10, "name", LAKE_SCHEMA)


@query
def compaction_report(spark, sf_dir):
    """Compact every hour into one file, plus a month that the lake does not have."""
    specs = [{}, {"year": 2024, "month": 13}]
    report = ops.compact_partitions(spark, raw_lake(spark, sf_dir), scratch_path(spark, "compacted"), specs)
    return report.select(
        "partition", "status", "rows_before", "rows_after", "files_before", "files_after"
    )


@query
def compaction_many_files(spark, sf_dir):
    """Every hour into three files, as far as it has rows for them."""
    report = ops.compact_partitions(
        spark, raw_lake(spark, sf_dir), scratch_path(spark, "compacted"), ALL_HOURS, num_files=3
    )
    return report.select(
        "partition", "status", "rows_before", "rows_after", "files_wanted",
        (F.col("files_after") <= F.col("files_wanted")).alias("within"),
    )


@query
def compaction_hot_hour(spark, sf_dir):
    """Every hour holds more than a file may: each is split, and no row is lost."""
    path = scratch_path(spark, "compacted")
    ops.compact_partitions(
        spark, raw_lake(spark, sf_dir), path, ALL_HOURS, max_file_bytes=512, raise_on_failure=True
    )
    return read_ticks(spark, path, LAKE_SCHEMA)


@query
def compacted_rows(spark, sf_dir):
    return read_ticks(spark, compacted_lake(spark, sf_dir), LAKE_SCHEMA)


@query
def repeated_compaction(spark, sf_dir):
    """Compact every hour twice, the second time with overlapping specs: nothing changes."""
    raw, path = raw_lake(spark, sf_dir), scratch_path(spark, "compacted")
    for specs in (ALL_HOURS, [{}, *first_days(spark, sf_dir)]):
        ops.compact_partitions(spark, raw, path, specs, raise_on_failure=True)
    return read_ticks(spark, path, LAKE_SCHEMA)


@query
def verified_compaction(spark, sf_dir):
    """Per-day file counts of the snapshots around a compaction of every hour."""
    done = compact_and_verify(
        spark,
        raw_lake(spark, sf_dir),
        scratch_path(spark, "compacted"),
        ALL_HOURS,
        scratch_path(spark, "snapshots"),
        per_partition=True,
    )
    return ops.compaction_reduction(done.before, done.after, per_partition=True)


def first_days(spark: SparkSession, sf_dir: str) -> list[dict[str, int]]:
    """The earlier half of the days that the data have: a spec each."""
    names = PARTITION_COLS[:3]
    days = ticks_of(spark, sf_dir).select(*names).distinct().orderBy(*names).collect()
    return [row.asDict() for row in days[: (len(days) + 1) // 2]]


def _half_compacted(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "compacted")
    ops.compact_partitions(
        spark, raw_lake(spark, sf_dir), path, first_days(spark, sf_dir), raise_on_failure=True
    )
    return path


@query
def ticks_view(spark, sf_dir):
    """First days from the compacted root, the others from raw."""
    return tick_view(spark, raw_lake(spark, sf_dir), _half_compacted(spark, sf_dir))


@query
def ticks_view_late(spark, sf_dir):
    """The view after rows of one ticker arrived late, in hours that had been compacted."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "compacted")
    ticks = ticks_of(spark, sf_dir)
    late = F.coalesce(F.col("ticker") == TICKER, F.lit(False))
    ops.save_table(ticks.where(~late), raw, PARTITION_COLS, mode="append", spread=SPREAD)
    ops.compact_partitions(spark, raw, path, ALL_HOURS, raise_on_failure=True)
    ops.save_table(ticks.where(late), raw, PARTITION_COLS, mode="append", spread=SPREAD)
    return tick_view(spark, raw, path)


@query
def stale_hours(spark, sf_dir):
    return hours_needing_compaction(spark, raw_lake(spark, sf_dir), _half_compacted(spark, sf_dir))


def _rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all ticks: the first days compacted and rolled up, the others still in raw."""
    at = (spark.sparkContext.applicationId, f"{sf_dir}#rollup")
    if at not in _lakes:
        _lakes[at] = scratch_path(spark, "rolled")
        ops.compact_partitions(
            spark, raw_lake(spark, sf_dir), f"{_lakes[at]}/hours", first_days(spark, sf_dir), raise_on_failure=True
        )
        update_rollup(spark, f"{_lakes[at]}/hours", f"{_lakes[at]}/states")
    return lake_states(spark, raw_lake(spark, sf_dir), f"{_lakes[at]}/hours", f"{_lakes[at]}/states")


@query
def ticker_summary_rollup(spark, sf_dir):
    return from_states.ticker_summary_of(_rolled_up(spark, sf_dir))


@query
def ticker_kpis_rollup(spark, sf_dir):
    return from_states.ticker_kpis_of(_rolled_up(spark, sf_dir))


@query
def avg_price_by_hour_ticker_rollup(spark, sf_dir):
    return from_states.avg_price_by_hour_ticker_of(_rolled_up(spark, sf_dir))


@query
def record_count_by_ticker_rollup(spark, sf_dir):
    return from_states.record_count_by_ticker_of(_rolled_up(spark, sf_dir))


@query
def ticker_summary_rollup_late(spark, sf_dir):
    """From states, after rows of one ticker arrived late and half the days were compacted, but not rolled up, again."""
    raw, path, rollup = (scratch_path(spark, name) for name in ("raw", "compacted", "states"))
    ticks = ticks_of(spark, sf_dir)
    late = F.coalesce(F.col("ticker") == TICKER, F.lit(False))
    ops.save_table(ticks.where(~late), raw, PARTITION_COLS, mode="append", spread=SPREAD)
    ops.compact_partitions(spark, raw, path, ALL_HOURS, raise_on_failure=True)
    update_rollup(spark, path, rollup)
    ops.save_table(ticks.where(late), raw, PARTITION_COLS, mode="append", spread=SPREAD)
    ops.compact_partitions(spark, raw, path, first_days(spark, sf_dir), raise_on_failure=True)
    return from_states.ticker_summary_of(lake_states(spark, raw, path, rollup))


def _user_lake(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Ticks with users as tickers: the first days compacted, all of these but the last indexed, the others still in raw."""
    at = (spark.sparkContext.applicationId, f"{sf_dir}#users")
    if at not in _lakes:
        _lakes[at] = root = scratch_path(spark, "users")
        ops.save_table(_user_ticks(spark, sf_dir), f"{root}/raw", PARTITION_COLS, mode="append", spread=1)
        days = first_days(spark, sf_dir)
        ops.compact_partitions(spark, f"{root}/raw", f"{root}/compacted", days, raise_on_failure=True)
        update_file_index(spark, f"{root}/compacted", f"{root}/index")
        # Another run has other files, which are not indexed yet.
        ops.compact_partitions(spark, f"{root}/raw", f"{root}/compacted", days[-1:], raise_on_failure=True)
    return tuple(f"{_lakes[at]}/{name}" for name in ("raw", "compacted", "index"))


def _user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
    return events_as_ticks(table(spark, sf_dir, "events").withColumn("event_type", user))


def rarest_users(spark: SparkSession, sf_dir: str) -> list[str]:
    """The three tickers with the fewest rows."""
    counts = _user_ticks(spark, sf_dir).where("ticker IS NOT NULL").groupBy("ticker").count()
    return [row.ticker for row in counts.orderBy("count", "ticker").limit(3).collect()]


@query
def rare_ticker_ticks(spark, sf_dir):
    """All rows of the rarest tickers, from the files that can hold them."""
    return indexed_ticks(spark, *_user_lake(spark, sf_dir), rarest_users(spark, sf_dir))


@query
def rare_ticker_ticks_since(spark, sf_dir):
    return indexed_ticks(spark, *_user_lake(spark, sf_dir), rarest_users(spark, sf_dir), since=RARE_SINCE)


@query
def saved_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    ops.save_table(ops.ticker_summary(ticks_of(spark, sf_dir)), path)
    return read_ticks(spark, path)


# ---- streams ----------------------------------------------------------------------------------


@query
def tick_stream_roundtrip(spark, sf_dir):
    """Messages through the streaming ingest into an hour-partitioned table."""
    root = scratch_path(spark, "stream")
    finish(
        streaming.ingest_ticks(
            events_as_messages(event_stream(spark, sf_dir)),
            f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoints",
            available_now=True, spread=SPREAD,
        )
    )
    return read_ticks(spark, f"{root}/raw", LAKE_SCHEMA)


@query
def message_file_stream(spark, sf_dir):
    """Messages in text files, one per line, through the file source, several files per batch."""
    root = scratch_path(spark, "stream")
    messages = events_as_messages(table(spark, sf_dir, "events"))
    messages.select(F.col("value").cast("string")).write.text(f"{root}/inbox")
    ticks = with_time_partitions(
        parse_ticks(tick_source(spark, "files", path=f"{root}/inbox", max_files_per_trigger=100))
    )
    finish(
        streaming.write_tick_stream(
            ticks, f"{root}/raw", f"{root}/checkpoint", available_now=True, spread=SPREAD
        )
    )
    return read_ticks(spark, f"{root}/raw", LAKE_SCHEMA)


@query
def restarted_tick_stream(spark, sf_dir):
    """The ingest stopped and started again from its checkpoint: every message once."""
    root = scratch_path(spark, "stream")
    for _ in range(2):
        ticks = with_time_partitions(parse_ticks(events_as_messages(event_stream(spark, sf_dir))))
        finish(
            streaming.write_tick_stream(
                ticks, f"{root}/raw", f"{root}/checkpoint", available_now=True, spread=SPREAD
            )
        )
    return ops.ticks_by_partition(read_ticks(spark, f"{root}/raw", LAKE_SCHEMA))


@query
def ticks_after_dead_batch(spark, sf_dir):
    """Three batches, the second of which dies once after its files are written: every tick once."""
    raw, ticks = scratch_path(spark, "raw"), ticks_of(spark, sf_dir)
    share = F.pmod(F.xxhash64("ticker", "ts"), F.lit(3))
    for number in range(3):
        rows = gather_partitions(ticks.where(share == number), PARTITION_COLS, SPREAD)
        if number == 1:
            begin_batch(spark, raw, f"stream-{number}", lambda attempt: place_batch(rows, raw, attempt, PARTITION_COLS))
        write_batch(rows, raw, f"stream-{number}", PARTITION_COLS)
    return read_ticks(spark, raw, LAKE_SCHEMA)


@query
def quarantine_stream(spark, sf_dir):
    """Damaged messages through the same ingest: counts of both sides."""
    root = scratch_path(spark, "stream")
    finish(
        streaming.ingest_ticks(
            drifting_messages(event_stream(spark, sf_dir)),
            f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoints",
            available_now=True, spread=SPREAD,
        )
    )
    good = read_ticks(spark, f"{root}/raw", LAKE_SCHEMA).select(F.lit("good").alias("outcome"))
    bad = read_ticks(spark, f"{root}/quarantine").select(F.col("reason").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_messages"))


def _inbox(spark: SparkSession, path: str, messages: DataFrame, n_files: int) -> None:
    """Add messages to a folder of text files, a batch each."""
    messages.select(F.col("value").cast("string")).repartition(n_files).write.mode("append").text(path)


def _ingest_inbox(spark: SparkSession, root: str, **options) -> None:
    finish(
        streaming.ingest_ticks(
            tick_source(spark, "files", path=f"{root}/inbox", max_files_per_trigger=1),
            f"{root}/raw", f"{root}/quarantine", f"{root}/checkpoints",
            available_now=True, spread=SPREAD, **options,
        )
    )


@query
def observed_ingest(spark, sf_dir):
    """Damaged messages in several batches and two runs of the stream: totals of what was observed of the batches."""
    root = scratch_path(spark, "stream")
    messages = drifting_messages(table(spark, sf_dir, "events"))
    for _ in range(2):
        _inbox(spark, f"{root}/inbox", messages, 2)
        with streaming.recorded_progress(spark, f"{root}/progress"):
            _ingest_inbox(spark, root)
    return streaming.read_progress(spark, f"{root}/progress").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n_messages").alias("n_messages"),
        F.sum("n_bad").alias("n_bad"),
        F.min("oldest_ts").alias("oldest_ts"),
        F.max("newest_ts").alias("newest_ts"),
        F.count_if(F.expr("seconds > 0 AND lag_seconds > 0")).alias("n_timed"),
    )


@query
def repeated_messages_stream(spark, sf_dir):
    """Each message twice in the first run of a stream, in batches of their own, and once more in the second."""
    root = scratch_path(spark, "stream")
    messages = events_as_messages(table(spark, sf_dir, "events"))
    for copies in (2, 1):
        for _ in range(copies):
            _inbox(spark, f"{root}/inbox", messages, 1)
        _ingest_inbox(spark, root, repeats_within="1 day")
    return read_ticks(spark, f"{root}/raw", LAKE_SCHEMA)


@query
def unpartitioned_stream(spark, sf_dir):
    root = scratch_path(spark, "stream")
    parsed = parse_ticks(events_as_messages(event_stream(spark, sf_dir)))
    finish(
        streaming.write_tick_stream(
            parsed, f"{root}/table", f"{root}/checkpoint", partition_cols=(), available_now=True
        )
    )
    return read_ticks(spark, f"{root}/table", TICK_SCHEMA)


@query
def windowed_ticker_stats(spark, sf_dir):
    return streaming.windowed_ticker_stats(ticks_of(spark, sf_dir), "1 hour")


@query
def sliding_ticker_stats(spark, sf_dir):
    return streaming.windowed_ticker_stats(ticks_of(spark, sf_dir), "1 hour", slide="30 minutes")


@query
def windowed_stats_stream(spark, sf_dir):
    """Append mode: the windows that the watermark has closed."""
    root = scratch_path(spark, "stream")
    stats = streaming.windowed_ticker_stats(
        events_as_ticks(event_stream(spark, sf_dir)), "1 hour", watermark="1 hour"
    )
    finish(
        streaming.write_window_stats(stats, f"{root}/stats", f"{root}/checkpoint", available_now=True)
    )
    return spark.read.schema(stats.schema).parquet(f"{root}/stats")


@query
def windowed_stats_complete_stream(spark, sf_dir):
    """Complete mode: every window, open ones too."""
    root = scratch_path(spark, "stream")
    stats = streaming.windowed_ticker_stats(events_as_ticks(event_stream(spark, sf_dir)), "1 hour")
    finish(
        streaming.write_window_stats(
            stats, f"{root}/stats", f"{root}/checkpoint", mode="complete", available_now=True
        )
    )
    return read_newest_snapshot(spark, f"{root}/stats")


@query
def windowed_stats_update_stream(spark, sf_dir):
    """Update mode: every window, open ones too, from a state that the watermark bounds."""
    root = scratch_path(spark, "stream")
    stats = streaming.windowed_ticker_stats(
        events_as_ticks(event_stream(spark, sf_dir)), "1 hour", watermark="1 hour"
    )
    finish(
        streaming.write_window_stats(
            stats, f"{root}/stats", f"{root}/checkpoint", mode="update", available_now=True
        )
    )
    return streaming.read_window_stats(spark, f"{root}/stats")


@query
def latest_ticks_stream(spark, sf_dir):
    root = scratch_path(spark, "stream")
    finish(
        streaming.latest_ticks_stream(
            events_as_ticks(event_stream(spark, sf_dir)),
            f"{root}/latest", f"{root}/checkpoint", 5, available_now=True,
        )
    )
    return streaming.read_latest_ticks(spark, f"{root}/latest", 5)
