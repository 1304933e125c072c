"""An index of the compacted files: which of them can hold a ticker, or a time.

For each file it keeps the span of its times, and Bloom filters of its tickers. A filter is one bitmap of Spark's
fixed size, which ``TICKERS_PER_FILTER`` tickers fill to about one false positive in a hundred; a file
with more of them has several filters, and a ticker's hash says which one is its own. So the index
grows with the tickers of each file, and answers equally well for any number. A filter never misses a ticker that is
there: a scan opens too many files at worst, never too few, and still compares tickers.

Like a rollup (whose folders and versions it shares), the index is kept per run: files of a run never change.
Hours that are not indexed yet, and raw for those that are open, are scanned as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import Specs, hour_key
from ..schema import LAKE_SCHEMA
from ..scratch import stage
from ..sources.commits import RUN_COL, compacted_hours
from ..sources.lake import read_hours
from .maintenance import changed_hours, read_raw, selected_hours
from .rollup import MAX_FOLDERS, kept_rows, rolled_runs, update_kept

# Fixed value: the bits of a bitmap that bitmap_construct_agg makes.
FILTER_BITS = 8 * 4096
#: Positions that a ticker sets in its filter.
PROBES = 4
TICKERS_PER_FILTER = 3_000

_INDEX = (
    "hour_key bigint, file string, rows bigint, min_ts timestamp, max_ts timestamp, "
    "n_filters int, filter_no int, filter binary"
)


def _filter_no(ticker: Column, n_filters: Column) -> Column:
    return F.pmod(F.xxhash64(ticker, F.lit("filter")), n_filters).cast("int")


def _probe(ticker: Column, number: Column | int) -> Column:
    number = number if isinstance(number, Column) else F.lit(number)
    return F.pmod(F.xxhash64(ticker, number.cast("int")), F.lit(FILTER_BITS)).cast("int")


def _index_files(ticks: DataFrame) -> DataFrame:
    """A row per file and filter. Rows meet by (file, ticker) first, so a hot ticker sends one row a task."""
    file = F.regexp_extract("_metadata.file_path", rf"/({RUN_COL}=[^/]*/.*)$", 1)
    keys = ["hour_key", "file"]
    seen = stage(
        ticks.select(hour_key().alias("hour_key"), file.alias("file"), "ticker", "ts")
        .groupBy(*keys, "ticker")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")),
        "indexed-tickers",
    )
    files = seen.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.greatest(F.lit(1), F.ceil(F.count("ticker") / TICKERS_PER_FILTER)).cast("int").alias("n_filters"),
    )
    sized = stage(files, "indexed-files")
    probes = F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))).alias("_probe")
    filters = (
        seen.where("ticker IS NOT NULL")
        .join(sized.select(*keys, "n_filters"), keys)
        .select(*keys, "ticker", _filter_no(F.col("ticker"), F.col("n_filters")).alias("filter_no"), probes)
        .groupBy(*keys, "filter_no")
        .agg(F.bitmap_construct_agg(_probe(F.col("ticker"), F.col("_probe"))).alias("filter"))
    )
    # A file without any ticker has a row too, which no ticker fits.
    return sized.join(filters, keys, "left")


def update_file_index(
    spark: SparkSession,
    compacted: str,
    index: str,
    schema: T.StructType = LAKE_SCHEMA,
    max_folders: int = MAX_FOLDERS,
) -> int:
    """Index the files of the compacted hours that are not indexed yet; returns how many hours that were.

    Only those hours are read, and of them two columns. Published whole, as ``update_rollup`` is.
    """
    return update_kept(
        spark, compacted, index, _index_files, _INDEX, ["hour_key", "file", "filter_no"], schema, max_folders
    )


def can_hold(ticker: str) -> Column:
    """Whether a row of the index is the filter that has, or seems to have, a ticker."""
    value = F.lit(ticker)

    def is_set(number: int) -> Column:
        at = _probe(value, number)
        byte = F.conv(F.hex(F.substring("filter", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(at, F.lit(8))) == 1

    bits = reduce(lambda a, b: a & b, [is_set(number) for number in range(PROBES)])
    return F.coalesce((F.col("filter_no") == _filter_no(value, F.col("n_filters"))) & bits, F.lit(False))


def _bound(value: dt.datetime | str | Column) -> Column:
    """Text and naive datetimes are read in the session zone, as ``ticks_since`` does."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.isoformat(" ")
    return F.lit(value).cast("timestamp")


def ticks_of(
    spark: SparkSession,
    raw: str,
    compacted: str,
    index: str,
    tickers: Sequence[str],
    since: dt.datetime | str | Column | None = None,
    until: dt.datetime | str | Column | None = None,
    specs: Specs | None = None,
    schema: T.StructType = LAKE_SCHEMA,
) -> DataFrame:
    """The rows of some tickers, ``since <= ts < until``, of all that ``tick_view`` shows.

    Of compacted hours that are up to date and indexed, only files that can hold such rows are opened, and none is
    listed; within them Parquet's statistics skip row groups, as rows are sorted by ticker. The names of
    those files come to the driver, as the names of all files of a scan do.
    """
    wanted = list(dict.fromkeys(tickers))
    if not wanted or any(ticker is None for ticker in wanted):
        raise ValueError("tickers must name at least one ticker, and no NULL")
    matches = F.col("ticker").isin(wanted)
    low, high = (None if value is None else _bound(value) for value in (since, until))
    holds = reduce(or_, [can_hold(ticker) for ticker in wanted])
    if low is not None:
        matches, holds = matches & (F.col("ts") >= low), holds & (F.col("max_ts") >= low)
    if high is not None:
        matches, holds = matches & (F.col("ts") < high), holds & (F.col("min_ts") < high)

    hours = selected_hours(compacted_hours(spark, compacted), specs)
    open_hours = changed_hours(spark, raw, hours, specs).where("hour_key >= -1").select("hour_key")
    found = read_raw(spark, raw, specs, schema).where(matches).join(open_hours, "hour_key", "left_semi").drop("hour_key")
    if hours is None:
        return found
    current = hours.withColumn("hour_key", hour_key()).join(open_hours, "hour_key", "left_anti")
    dealt = stage(current.join(rolled_runs(spark, index), RUN_COL, "left"), "index-hours")
    indexed, others = dealt.where("folder IS NOT NULL"), dealt.where("folder IS NULL")
    files = kept_rows(spark, index, indexed, _INDEX).where(holds).select("file").distinct().collect()
    if files:
        reader = spark.read.schema(schema).option("basePath", compacted)
        paths = sorted(f"{compacted}/{row.file}" for row in files)
        found = found.unionByName(reader.parquet(*paths).drop(RUN_COL).where(matches))
    if not others.isEmpty():
        found = found.unionByName(read_hours(spark, compacted, others, schema).where(matches))
    return found
