"""Small-file compaction from an immutable raw root into a separate compacted root.

Specs select hours and the hour is always the grain of the output, so a coarse spec never
changes the directory layout. Compacted hours are recomputed from raw: running a selection
again gives the same table, and late rows are picked up by compacting their hour again.

A run writes below a directory of its own and is published whole, by one new version of the table of
compacted hours (``sources.commits``); then the hours it replaced are deleted. An hour whose rows are not all there is
reported and not published.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import ALL_HOURS, Spec, Specs, as_specs, format_spec, hour_key
from ..schema import INVENTORY_SCHEMA, LAKE_SCHEMA, PARTITION_COLS
from ..scratch import stage
from ..sources.commits import RUN_COL, claim_run, publish_run, run_folder
from ..sources.lake import load_partitions, path_is_missing, read_partitions
from ..sources.paths import remove_folder
from .sinks import PLACED_BY_TASKS, WITHOUT_SIDE_FILES
from .small_files import small_files, suits_small_files, write_small_files

# Raw data that one write task takes before another task is worth its start-up.
TASK_BYTES = 128 << 20

_STATS = ("files", "bytes", "rows")

_FILES_SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.IntegerType()) for name in PARTITION_COLS],
        *INVENTORY_SCHEMA.fields,
        T.StructField("rows", T.LongType()),
    ]
)
_COUNTS = [f"{count}_{side}" for side in ("before", "after") for count in _STATS]
_NUMBERS = ["files_wanted", *_COUNTS]
_REPORT_SCHEMA = ", ".join(
    ["partition string, status string, message string", *[f"{name} bigint" for name in _NUMBERS]]
)

# A job that Spark aborts surfaces as the second kind.
_SPARK_ERRORS = (PySparkException, Py4JJavaError)

#: An hour gets as many files as keep each of them below so much raw data, and ``num_files`` at least.
MAX_FILE_BYTES = 1 << 30


class CompactionError(RuntimeError):
    """At least one selected partition was not compacted."""


@dataclass(frozen=True)
class Compaction:
    """A finished run: its report, and the selected files of both roots around it."""

    report: DataFrame
    before: DataFrame
    after: DataFrame


def partition_files(table: DataFrame) -> DataFrame:
    """Path, size, age and row count of every file of a lake table, read from footers only."""
    return table.groupBy(
        *PARTITION_COLS,
        F.col("_metadata.file_path").alias("key"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def damaged_files(
    spark: SparkSession, root: str, specs: Specs, schema: T.StructType = LAKE_SCHEMA
) -> DataFrame:
    """``year, month, day, hour, key`` of the selected files that cannot be read whole.

    Every column of every file is read, and what a file gave up is compared with the row count in its
    footer; a file without a readable footer has none, nor has one without rows.
    """
    chosen = as_specs(specs)
    listing = load_partitions(
        spark, spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet"), root, chosen
    ).select(*[F.col(name).cast("int") for name in PARTITION_COLS], F.col("_metadata.file_path").alias("key"))
    lenient = spark.read.schema(schema).option("ignoreCorruptFiles", "true").format("parquet")
    ticks = load_partitions(spark, lenient, root, chosen)
    data = [name for name in schema.fieldNames() if name not in PARTITION_COLS]
    read = ticks.groupBy(F.col("_metadata.file_path").alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*data)).alias("content")
    )
    # The digest makes the scan read all columns; it is never missing where there is a row.
    intact = partition_files(ticks).select("key", "rows").join(read.where("content IS NOT NULL"), ["key", "rows"])
    return listing.join(intact, "key", "left_anti").select(*PARTITION_COLS, "key")


def listed_files(spark: SparkSession, root: str, specs: Specs) -> DataFrame:
    """Hour, path and size of the selected files of a raw root, from the listing alone: no file is opened."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        table = load_partitions(spark, reader, root, as_specs(specs))
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], _FILES_SCHEMA).drop("last_modified", "rows")
    return table.select(
        *[F.col(name).cast("int") for name in PARTITION_COLS],
        F.col("_metadata.file_path").alias("key"), F.col("length").alias("size"),
    )


def fingerprints(files: DataFrame) -> DataFrame:
    """Number, bytes and an order-free digest of each hour's files, by their place below the root and size."""
    place = F.regexp_extract("key", r"/(year=[^/]*/.*)$", 1)
    return files.groupBy(*PARTITION_COLS).agg(
        F.count(F.lit(1)).alias("source_files"),
        F.sum("size").alias("source_bytes"),
        F.bit_xor(F.xxhash64(place, "size")).alias("source_hash"),
    )


def partition_stats(files: DataFrame) -> DataFrame:
    """Files, bytes and rows per hour directory."""
    return (
        files.groupBy(*PARTITION_COLS)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size").alias("bytes"),
            F.sum("rows").alias("rows"),
        )
    )


def compact_partitions(
    spark: SparkSession,
    raw: str,
    compacted: str,
    specs: Specs,
    num_files: int = 1,
    max_file_bytes: int = MAX_FILE_BYTES,
    schema: T.StructType = LAKE_SCHEMA,
    raise_on_failure: bool = False,
    keep_versions: int = 1,
) -> DataFrame:
    """Rewrite the selected hours of ``raw`` into ``compacted`` with ``num_files`` files each.

    Readers see the run whole or not at all. What it replaces is deleted, unless ``keep_versions`` leaves it to readers
    that have begun, until so many later runs were published.

    An hour with more than ``num_files * max_file_bytes`` of raw data gets as many more files
    as that takes, so a hot hour is written by many tasks. All hours go through one job. If that
    fails, one more job looks for damaged files; their hours are reported as failed, with the file's
    name, and all others go through one job again.

    Returns one row per compacted hour plus one per spec that selected nothing or failed:
    ``partition, status, message, files_wanted, files/bytes/rows before and after``. An hour with
    fewer rows than ``files_wanted`` gets fewer files. ``status`` is
    ``compacted``, ``row_mismatch``, ``missing`` or ``failed``.
    """
    report = run_compaction(spark, raw, compacted, specs, num_files, max_file_bytes, schema, keep_versions).report
    if raise_on_failure:
        problems = report.where(F.col("status") != "compacted").limit(20).collect()
        if problems:
            raise CompactionError("; ".join(f"{p.partition}: {p.status} {p.message or ''}" for p in problems))
    return report


def run_compaction(
    spark: SparkSession,
    raw: str,
    compacted: str,
    specs: Specs,
    num_files: int = 1,
    max_file_bytes: int = MAX_FILE_BYTES,
    schema: T.StructType = LAKE_SCHEMA,
    keep_versions: int = 1,
) -> Compaction:
    """:func:`compact_partitions`, with the file lists the report is made from."""
    if num_files < 1 or max_file_bytes < 1 or keep_versions < 1:
        raise ValueError("num_files, max_file_bytes and keep_versions must be positive")

    def attempt(damaged: DataFrame | None = None) -> Compaction:
        return _compact(spark, raw, compacted, num_files, max_file_bytes, schema, keep_versions, wanted, damaged)

    wanted, no_files = as_specs(specs), spark.createDataFrame([], _FILES_SCHEMA)
    if not wanted:
        return Compaction(_failure_report(spark, []), no_files, no_files)
    try:
        return attempt()
    except _SPARK_ERRORS as error:
        cause = error
    try:
        damaged = stage(damaged_files(spark, raw, wanted, schema), "compaction-damaged")
        if not damaged.isEmpty():
            return attempt(damaged)
    except _SPARK_ERRORS as error:
        cause = error
    return Compaction(_failure_report(spark, [(spec, cause) for spec in wanted]), no_files, no_files)


def _compact(
    spark: SparkSession,
    raw: str,
    compacted: str,
    num_files: int,
    max_file_bytes: int,
    schema: T.StructType,
    keep_versions: int,
    specs: list[Spec],
    damaged: DataFrame | None,
) -> Compaction:
    # One listing of raw serves the file list and the rewrite: files that the stream adds
    # meanwhile belong to neither. Both lists are staged, since a later run may replace the files.
    source = read_partitions(spark, raw, specs, schema)
    if damaged is not None:
        # One number per damaged hour comes to the driver, and keeps its directory from being read.
        hours = [row.hour_key for row in damaged.select(hour_key().alias("hour_key")).distinct().collect()]
        source = source.where(~hour_key().isin(hours))
    before = stage(partition_files(source), "compaction-before")

    n_files = F.greatest(F.lit(num_files), F.ceil(F.col("bytes") / max_file_bytes)).cast("int")
    sized = partition_stats(before).withColumn("_files", n_files)
    total = sized.agg(
        F.sum("_files").alias("files"), F.max("_files").alias("most"), F.sum("bytes").alias("bytes")
    ).first()
    if total.files is not None:
        useful = max(spark.sparkContext.defaultParallelism, total.bytes // TASK_BYTES)
        tasks = max(total.most, min(total.files, useful))
        # Only a part of the hash, so that the sum cannot overflow.
        start = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 32))
        position = start + F.col("_metadata.row_index")
        placed = source.select("*", position.alias("_position"))
        if total.most == num_files:
            placed = placed.withColumn("_files", F.lit(num_files))
        else:
            hot = stage(sized.select(hour_key().alias("_hour"), "_files"), "compaction-sizes")
            placed = placed.withColumn("_hour", hour_key()).join(hot, "_hour")
        run = claim_run(spark, compacted)
        folder = run_folder(compacted, run)
        small = suits_small_files(spark, folder, max_file_bytes, schema)
        try:
            _write(placed, folder, tasks, schema, small)
            if small:
                written = small_files(sized, folder, total.files)
            else:
                table = spark.read.schema(schema).option("basePath", compacted).parquet(folder)
                written = partition_files(table.drop(RUN_COL))
            after = stage(written, "compaction-after")
            publish_run(spark, compacted, stage(_new_hours(run, before, after), "compacted-hours"), keep_versions)
        except BaseException:
            remove_folder(spark, folder)
            raise
    else:
        after = spark.createDataFrame([], _FILES_SCHEMA)
    report, found = _report(sized, partition_stats(after)), sized.select(*PARTITION_COLS)
    if damaged is not None:
        report = report.unionByName(_damage_report(damaged))
        found = found.unionByName(damaged.select(*PARTITION_COLS))
    return Compaction(report.unionByName(_missing_report(spark, found, specs)), before, after)


def _new_hours(run: int, before: DataFrame, after: DataFrame) -> DataFrame:
    """What the run has to publish: its hours, as far as they hold all rows of their source files."""
    key = hour_key().alias("hour_key")
    rows = before.groupBy(key).agg(F.sum("rows").alias("_rows"))
    sources = fingerprints(before).withColumn("hour_key", hour_key()).drop(*PARTITION_COLS).join(rows, "hour_key")
    hours = partition_stats(after).withColumn("hour_key", hour_key()).join(sources, "hour_key")
    whole = hours.where(F.col("rows") == F.col("_rows"))
    counts = hours.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rows") == F.col("_rows")).alias("whole")).first()
    run_hours = F.lit(counts.n if counts.n == counts.whole else None).cast("bigint")
    return whole.select(
        *PARTITION_COLS, F.lit(run).cast("bigint").alias(RUN_COL), "files", "bytes", "rows",
        "source_files", "source_bytes", "source_hash", run_hours.alias("run_hours"),
    )


def _write(placed: DataFrame, folder: str, tasks: int, schema: T.StructType, small: bool) -> None:
    """Spread each hour over ``_files`` tasks by row position.

    An hour starts at a hashed task and takes the ``_files`` tasks from there, which are distinct
    because ``tasks`` is never lower: one file per task. The position (file and row number)
    depends on the data files alone, so a task that is run again places its rows as before; and
    it spreads identical rows as evenly as any others. Rows are sorted by ticker and time within
    a file, which keeps row-group statistics selective for both.
    """
    slot = F.pmod("_position", "_files")
    task = F.pmod(F.pmod(F.xxhash64(*PARTITION_COLS), F.lit(tasks)) + slot, F.lit(tasks)).cast("int")
    columns = schema.fieldNames()
    order = [name for name in ("ticker", "ts") if name in columns]
    rows = (
        placed.select(*columns, task.alias("_task"))
        .repartitionById(tasks, F.col("_task"))
        .select(*columns)
        .sortWithinPartitions(*PARTITION_COLS, *order)
    )
    if small:
        write_small_files(rows, folder)
    else:
        rows.write.options(**PLACED_BY_TASKS, **WITHOUT_SIDE_FILES).partitionBy(*PARTITION_COLS).parquet(folder)


def _partition_label() -> Column:
    return F.concat_ws(
        "/",
        *[F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("null"))) for name in PARTITION_COLS],
    )


def _report(before: DataFrame, after: DataFrame) -> DataFrame:
    wanted = F.col("_files").cast("bigint").alias("files_wanted")
    sides = [
        stats.select(hour_key().alias("hour_key"), *extra, *[F.col(c).alias(f"{c}_{side}") for c in _STATS])
        for stats, side, extra in ((before, "before", [*PARTITION_COLS, wanted]), (after, "after", []))
    ]
    joined = sides[0].join(sides[1], "hour_key", "left")  # rows without a time have a key too
    whole = F.col("rows_before") == F.coalesce("rows_after", F.lit(0))
    return joined.select(
        _partition_label().alias("partition"),
        F.when(whole, "compacted").otherwise("row_mismatch").alias("status"),
        *_no_values("message"),
        "files_wanted",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in _COUNTS],
    )


def _missing_report(spark: SparkSession, before: DataFrame, specs: list[Spec]) -> DataFrame:
    """The specs that selected no rows; one anti join per set of partition columns used."""
    found = spark.createDataFrame([], _REPORT_SCHEMA)
    by_columns: dict[tuple[str, ...], list[Spec]] = {}
    for spec in specs:
        by_columns.setdefault(tuple(sorted(spec)), []).append(spec)
    if by_columns.pop((), None) and before.isEmpty():
        nothing = spark.createDataFrame([(ALL_HOURS,)], "partition string")
        found = nothing.select("partition", F.lit("missing").alias("status"), *_no_values("message", *_NUMBERS))
    for columns, group in by_columns.items():
        asked = spark.createDataFrame(
            [(format_spec(spec).replace(",", "/"), *[spec[c] for c in columns]) for spec in group],
            ", ".join(["partition string", *[f"{c} int" for c in columns]]),
        )
        found = found.unionByName(
            asked.join(before, list(columns), "left_anti").select(
                "partition", F.lit("missing").alias("status"), *_no_values("message", *_NUMBERS)
            )
        )
    return found


def _cause(error: Exception) -> str:
    """The innermost cause that the JVM gives, which names the file; else the first line there is."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    causes = [line for line in lines if line.startswith("Caused by:")]
    return (causes[-1:] or lines or [type(error).__name__])[0]


def _damage_report(damaged: DataFrame) -> DataFrame:
    n_files = F.count(F.lit(1)).cast("string")
    message = F.concat(n_files, F.lit(" unreadable files, the first of them "), F.min("key"))
    return (
        damaged.groupBy(*PARTITION_COLS)
        .agg(message.alias("message"))
        .select(_partition_label().alias("partition"), F.lit("failed").alias("status"), "message", *_no_values(*_NUMBERS))
    )


def _failure_report(spark: SparkSession, failed: list[tuple[Spec, Exception]]) -> DataFrame:
    rows = [
        (format_spec(spec).replace(",", "/"), "failed", _cause(error))
        for spec, error in failed
    ]
    return spark.createDataFrame(rows, "partition string, status string, message string").select(
        "*", *_no_values(*_NUMBERS)
    )


def _no_values(*names: str) -> list[Column]:
    return [
        F.lit(None).cast("string" if name == "message" else "bigint").alias(name) for name in names
    ]
