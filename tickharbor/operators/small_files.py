"""Very small Parquet files on a local disk, written and counted by Arrow in Python workers.

Without Hadoop's native library its local file system starts a ``chmod`` process for each file and each directory, and
Spark needs milliseconds to open a file: with a few rows in each, that is nearly all the work. On other file systems
nothing of the kind happens; they, larger files and other column types keep Spark's writer and reader.

The functions that workers run are self-contained: workers need not find this package.
"""

from __future__ import annotations

from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PARTITION_COLS
from ..sources.paths import hadoop_setting, local_place, make_folder, remove_folder, umask

#: Up to so much raw data in a file, opening it costs more than its rows.
SMALL_FILE_BYTES = 1 << 20
# Footers that one task reads before another task is worth its start-up.
TASK_FILES = 2_000
# What a task holds of a file before it becomes a row group: raw data that compress well can make more rows than memory.
GROUP_BYTES = 64 << 20

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_VALUES = (*_NUMBERS, T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType)
# Names of Spark's setting as Arrow has them.
_CODECS = {"none": "NONE", "uncompressed": "NONE", "snappy": "SNAPPY", "zstd": "ZSTD", "gzip": "GZIP"}
_TEMPORARY = "_temporary"
# Names a factory of keys; files are encrypted by Spark's writer only.
_CRYPTO = "parquet.crypto.factory.class"


def suits_small_files(spark: SparkSession, folder: str, max_file_bytes: int, schema: T.StructType) -> bool:
    """Whether files of an hour-partitioned table are small, on a local disk, and the same if Arrow writes them."""
    data = [field.dataType for field in schema.fields if field.name not in PARTITION_COLS]
    hour = [schema[name].dataType for name in PARTITION_COLS]
    return (
        max_file_bytes <= SMALL_FILE_BYTES
        and all(type(kind) in _VALUES for kind in data)
        and all(type(kind) in _NUMBERS for kind in hour)
        and spark.conf.get("spark.sql.parquet.compression.codec").lower() in _CODECS
        and spark.conf.get("spark.sql.parquet.outputTimestampType") in ("INT96", "TIMESTAMP_MICROS")
        and spark.conf.get(_CRYPTO, None) is None
        and hadoop_setting(spark, _CRYPTO) is None
        and local_place(spark, folder) is not None
        and all(find_spec(name) for name in ("numpy", "pyarrow"))
    )


def write_small_files(rows: DataFrame, folder: str) -> None:
    """Write one file per task and hour; ``rows`` are sorted by hour within each task.

    A file appears whole, under a name that its task has in all attempts. As an attempt that runs again has the same
    rows, it puts the same files in place of those that are there; what it leaves unfinished goes with the temporary
    folder, without which late attempts cannot write.
    """
    spark = rows.sparkSession
    place, mask = local_place(spark, folder)[1], umask(spark)
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower()
    suffix = {"NONE": ".parquet", "GZIP": ".gz.parquet"}.get(_CODECS[codec], f".{codec}.parquet")
    suffix = f"-{folder.rpartition('=')[2]}.c000{suffix}"
    columns, levels = [name for name in rows.columns if name not in PARTITION_COLS], PARTITION_COLS
    noted = {
        "org.apache.spark.version": spark.version,
        "org.apache.spark.sql.parquet.row.metadata": rows.select(*columns)._jdf.schema().json(),
    }
    options = {
        "compression": _CODECS[codec],
        "use_deprecated_int96_timestamps": spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96",
        "store_schema": False,
        "write_page_checksum": True,
    }
    temporary, group_bytes = f"{place}/{_TEMPORARY}", GROUP_BYTES

    def write(batches):
        import os
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        made: set[str] = set()
        name = f"part-{TaskContext.get().partitionId():05d}{suffix}"
        attempt = f"{temporary}/{uuid.uuid4().hex}"
        at, held, n_held, writer, sink, written = None, [], 0, None, None, 0

        def flush():
            nonlocal held, n_held, writer, sink
            if writer is None:
                # A small file takes shape in memory: Arrow writes piece by piece, and each is a call to the system.
                sink = pa.OSFile(attempt, "wb") if n_held >= group_bytes else pa.BufferOutputStream()
                writer = pq.ParquetWriter(sink, held[0].schema, **options)
            writer.write_table(pa.Table.from_batches(held))
            held, n_held = [], 0

        def finish():
            nonlocal writer, written
            if held:
                flush()
            writer.add_key_value_metadata(noted)
            writer.close()
            if isinstance(sink, pa.BufferOutputStream):
                with open(attempt, "wb", buffering=0) as file:
                    file.write(sink.getvalue())
            else:
                sink.close()
            writer = None
            values = ("__HIVE_DEFAULT_PARTITION__" if value is None else value for value in at)
            hour = "/".join([place, *(f"{level}={value}" for level, value in zip(levels, values))])
            if hour not in made:
                os.makedirs(hour, exist_ok=True)
                made.add(hour)
            os.replace(attempt, f"{hour}/{name}")
            written += 1

        def take(batch):
            nonlocal at, n_held
            keys = [batch.column(level) for level in levels]
            starts = np.zeros(batch.num_rows, dtype=bool)
            starts[:1] = True
            for key in keys:
                numbers, missing = key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(False)
                starts[1:] |= (numbers[1:] != numbers[:-1]) | (missing[1:] != missing[:-1])
            bounds = [*np.flatnonzero(starts).tolist(), batch.num_rows]
            data = batch.select(columns)
            for low, high in zip(bounds, bounds[1:]):
                hour = tuple(key[low].as_py() for key in keys)
                if hour != at:
                    if at is not None:
                        finish()
                    at = hour
                held.append(data.slice(low, high - low))
                n_held += held[-1].nbytes
                if n_held >= group_bytes:
                    flush()

        usual = os.umask(mask)
        try:
            for batch in batches:
                take(batch)
            if at is not None:
                finish()
        finally:
            os.umask(usual)
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    make_folder(spark, f"{folder}/{_TEMPORARY}")
    rows.mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()
    remove_folder(spark, f"{folder}/{_TEMPORARY}")


def small_files(hours: DataFrame, folder: str, n_files: int) -> DataFrame:
    """Hour, path, size, age and row count of the files that ``folder`` holds of some hours; counts are from footers.

    As ``partition_files`` of a scan of the folder. Names are dealt out anew before footers are read, so those of a
    hot hour meet in no task.
    """
    spark, levels = hours.sparkSession, PARTITION_COLS
    uri, place = local_place(spark, folder)

    def names(batches):
        import os

        import pyarrow as pa

        kept = pa.schema([*((level, pa.int32()) for level in levels), ("name", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                values = ("__HIVE_DEFAULT_PARTITION__" if row[level] is None else row[level] for level in levels)
                hour = "/".join(f"{level}={value}" for level, value in zip(levels, values))
                try:
                    found = [f"{hour}/{name}" for name in os.listdir(f"{place}/{hour}") if name[0] not in "._"]
                except FileNotFoundError:
                    continue
                for low in range(0, len(found), 10_000):
                    part = found[low : low + 10_000]
                    fixed = [pa.array([row[level]] * len(part), pa.int32()) for level in levels]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(part)], schema=kept)

    def counts(batches):
        import os

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            sizes, ages, rows = [], [], []
            for name in batch.column("name").to_pylist():
                with open(f"{place}/{name}", "rb") as file:
                    status = os.fstat(file.fileno())
                    rows.append(pq.read_metadata(file).num_rows)
                sizes.append(status.st_size)
                ages.append(status.st_mtime_ns // 1_000_000)
            columns = {level: batch.column(level) for level in levels} | {"name": batch.column("name")}
            numbers = {"size": sizes, "age": ages, "rows": rows}
            yield pa.RecordBatch.from_pydict(columns | {key: pa.array(x, pa.int64()) for key, x in numbers.items()})

    place_schema = ", ".join(f"{level} int" for level in levels)
    chosen = hours.select(*[F.col(level).cast("int").alias(level) for level in levels])
    tasks = max(spark.sparkContext.defaultParallelism, n_files // TASK_FILES)
    found = chosen.mapInArrow(names, f"{place_schema}, name string").repartition(tasks)
    counted = found.mapInArrow(counts, f"{place_schema}, name string, size bigint, age bigint, rows bigint")
    return counted.select(
        *levels, F.concat(F.lit(f"{uri}/"), "name").alias("key"), "size",
        F.timestamp_millis("age").alias("last_modified"), "rows",
    )
