import os
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tickharbor.functions.parsing import add_partition_columns
from tickharbor.operators import CompactionError, compact_partitions
from tickharbor.operators import compaction, small_files
from tickharbor.operators.compaction import partition_files, run_compaction
from tickharbor.operators.inventory import CompactionCheckFailed
from tickharbor.operators.small_files import suits_small_files, write_small_files
from tickharbor.plans.maintenance import compact_and_verify, hours_needing_compaction, tick_view
from tickharbor.schema import LAKE_SCHEMA, PARTITION_COLS
from tickharbor.sources import read_ticks
from tickharbor.sources.paths import local_place

from .helpers import append, bag, data_files, plan, ticks

DAY = "year=2025,month=8,day=10"
COLUMNS = ("ticker", "price", "volume", "ts")


def hour_rows(hour, n, start=0):
    return [("AAPL", float(i), i, f"2025-08-10 {hour:02d}:00:{i:02d}") for i in range(start, start + n)]


@pytest.fixture
def roots(spark, base):
    """Two appends of three rows to each of two hours: 12 rows in 4 files."""
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    for start in (0, 3):
        append(ticks(spark, hour_rows(1, 3, start) + hour_rows(2, 3, start)).coalesce(1), raw)
    return raw, compacted


def compacted_rows(spark, compacted):
    return bag(read_ticks(spark, compacted, LAKE_SCHEMA), *COLUMNS)


def test_day_spec_over_a_live_lake_keeps_every_row(spark, roots):
    raw, compacted = roots
    report = compact_partitions(spark, raw, compacted, DAY).collect()
    assert {(r.status, r.rows_before, r.rows_after, r.files_before, r.files_after) for r in report} == {
        ("compacted", 6, 6, 2, 1)
    }
    assert sum(data_files(compacted).values()) == 2

    append(ticks(spark, hour_rows(4, 3)).coalesce(1), raw)
    assert tick_view(spark, raw, compacted).count() == 15
    compact_partitions(spark, raw, compacted, DAY)
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)
    assert sum(data_files(compacted).values()) == 3

    before = compacted_rows(spark, compacted)
    compact_partitions(spark, raw, compacted, DAY)
    assert compacted_rows(spark, compacted) == before
    assert sum(data_files(compacted).values()) == 3

    append(ticks(spark, hour_rows(1, 3, 20)).coalesce(1), raw)
    assert bag(tick_view(spark, raw, compacted), *COLUMNS) == bag(read_ticks(spark, raw), *COLUMNS)
    assert tick_view(spark, raw, compacted).count() == 18
    stale = hours_needing_compaction(spark, raw, compacted).collect()
    assert [tuple(r) for r in stale] == [(2025, 8, 10, 1, 9, 6)]
    compact_partitions(spark, raw, compacted, DAY + ",hour=1")
    assert tick_view(spark, raw, compacted).count() == 18
    assert hours_needing_compaction(spark, raw, compacted).count() == 0


def test_view_without_a_compacted_root_is_raw(spark, roots):
    raw, compacted = roots
    append(ticks(spark, [("X", 1.0, 1, None)]), raw)
    assert bag(tick_view(spark, raw, compacted), *COLUMNS) == bag(read_ticks(spark, raw), *COLUMNS)


def test_view_prunes_compacted_hours_of_raw(spark, roots):
    raw, compacted = roots
    compact_partitions(spark, raw, compacted, DAY + ",hour=1")
    view = tick_view(spark, raw, compacted)
    assert "dynamicpruning" in plan(view)
    assert view.count() == 12


def test_view_of_some_partitions(spark, roots):
    raw, compacted = roots
    compact_partitions(spark, raw, compacted, DAY + ",hour=1")
    for hour in (1, 2):
        view = tick_view(spark, raw, compacted, f"{DAY},hour={hour}")
        assert {r.hour for r in view.collect()} == {hour} and view.count() == 6
    assert hours_needing_compaction(spark, raw, compacted, DAY + ",hour=1").count() == 0
    assert hours_needing_compaction(spark, raw, compacted, DAY).count() == 1


@pytest.mark.parametrize("num_files", [1, 2, 5])
def test_every_hour_gets_the_asked_number_of_files(spark, base, num_files):
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    rows = [row for hour in range(24) for row in hour_rows(hour, 40)]
    append(ticks(spark, rows).repartition(7), raw)
    report = compact_partitions(spark, raw, compacted, DAY, num_files=num_files)
    assert {r.files_after for r in report.collect()} == {num_files}
    assert set(data_files(compacted).values()) == {num_files}
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)


def test_a_hot_hour_of_identical_rows_is_split_evenly(spark, base):
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    hot = [("HOT", 1.0, 1, "2025-08-10 09:00:00")] * 4000
    append(ticks(spark, hot + hour_rows(3, 5)).repartition(8), raw)
    report = compact_partitions(spark, raw, compacted, DAY, max_file_bytes=2000).collect()
    files = {r.partition.rsplit("/", 1)[1]: r.files_after for r in report}
    assert files["hour=3"] >= 1 and files["hour=9"] > 3
    sizes = [
        r["count"]
        for r in read_ticks(spark, compacted, LAKE_SCHEMA)
        .where("hour = 9")
        .groupBy("_metadata.file_name")
        .count()
        .collect()
    ]
    assert len(sizes) == files["hour=9"] and max(sizes) - min(sizes) <= 8
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)


def test_a_compacted_file_is_one_file_on_a_local_disk(spark, base):
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    append(ticks(spark, [row for hour in range(4) for row in hour_rows(hour, 40)]), raw)
    report = compact_partitions(spark, raw, compacted, DAY, max_file_bytes=512).collect()
    assert report and all(r.status == "compacted" and 1 < r.files_after <= r.files_wanted for r in report)
    found = [path.name for path in Path(compacted).glob("run=*/**/*") if path.is_file()]
    assert len(found) == sum(r.files_after for r in report)
    assert all(name.endswith(".parquet") for name in found)
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)
    # Only what a run writes: the options stay with the write, others on the same disk keep their checksum files.
    assert list(Path(raw).glob("**/.*.crc"))


def small_hours(spark, hours, rows):
    """``rows`` ticks of different values in each hour of a day."""
    n = spark.range(hours * rows, numPartitions=4)
    made = n.selectExpr(
        "concat('T', id % 5) AS ticker", "xxhash64(id) / 1e15 AS price", "CAST(id % 1000 AS int) AS volume",
        f"timestamp_micros(1754784000000000 + (id % {hours}) * 3600000000 + (id * 7919) % 3600000000) AS ts",
    )
    return add_partition_columns(made)


def test_small_files_cost_no_process_each(spark, base):
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    append(small_hours(spark, 24, 600).coalesce(1), raw)
    jvm = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/stat")

    def of_children():
        """Seconds of processors that ended processes of the JVM took; Python's workers do not end."""
        return sum(int(ticks) for ticks in jvm.read_text().rpartition(")")[2].split()[13:15]) / os.sysconf("SC_CLK_TCK")

    before = of_children()
    report = compact_partitions(spark, raw, compacted, DAY, max_file_bytes=512).collect()
    files = sum(r.files_after for r in report)
    assert files > 400 and {r.status for r in report} == {"compacted"} and len(report) == 24
    assert of_children() - before < 0.002 * files
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)


def test_small_files_are_those_that_spark_writes(spark, base, monkeypatch):
    raw, by_arrow, by_spark = f"{base}/raw", f"{base}/by arrow", f"{base}/by spark"
    append(small_hours(spark, 3, 200), raw)
    odd = [("X", float("nan"), None, "1969-12-31 23:59:59.999999"), (None, -0.0, -1, "1900-01-01 00:00:00.000001")]
    append(ticks(spark, [*odd, ("", None, 7, None), ("\u00e9\n", 1e300, 2**31 - 1, "2025-08-10 09:00:00.5")] * 60), raw)
    report, other = ["partition", "status", "files_wanted", "files_after", "rows_after"], "year = 2025 AND hour = 0"
    compact_partitions(spark, raw, by_arrow, "all", max_file_bytes=512)
    monkeypatch.setattr(compaction, "suits_small_files", lambda *_: False)
    written = compact_partitions(spark, raw, by_spark, "all", max_file_bytes=512).select(*report)
    monkeypatch.undo()
    again = compact_partitions(spark, raw, by_arrow, "all", max_file_bytes=512).select(*report)
    assert bag(again) == bag(written)
    tables = [read_ticks(spark, root, LAKE_SCHEMA) for root in (by_arrow, by_spark)]
    assert bag(tables[0].withColumn("price", F.col("price").cast("string"))) == bag(
        tables[1].withColumn("price", F.col("price").cast("string"))
    )
    spread = [
        Counter((r.hour, r["count"]) for r in t.where(other).groupBy("hour", "_metadata.file_name").count().collect())
        for t in tables
    ]
    assert spread[0] == spread[1]
    arrow, spark_s = (pq.ParquetFile(next(Path(root).rglob("hour=1/*.parquet"))) for root in (by_arrow, by_spark))
    assert arrow.schema.equals(spark_s.schema) and arrow.metadata.created_by != spark_s.metadata.created_by
    assert {column.compression for column in columns_of(arrow)} == {column.compression for column in columns_of(spark_s)}
    assert arrow.metadata.metadata == spark_s.metadata.metadata
    modes = [{path.stat().st_mode for path in Path(root).glob("run=*/**/*")} for root in (by_arrow, by_spark)]
    assert modes[0] == modes[1]


def columns_of(file):
    return [file.metadata.row_group(0).column(number) for number in range(file.metadata.num_columns)]


def test_small_files_are_listed_as_by_a_scan(spark, base):
    raw, compacted = f"{base}/raw", f"{base}/with space"
    append(ticks(spark, [*hour_rows(1, 40), *hour_rows(2, 40), ("X", 1.0, 1, None)]), raw)
    done = run_compaction(spark, raw, compacted, "all", max_file_bytes=512)
    scan = partition_files(read_ticks(spark, compacted, LAKE_SCHEMA))
    assert bag(done.after) == bag(scan) and done.after.count() > 3
    assert done.after.dtypes == scan.dtypes


def test_an_attempt_that_runs_again_puts_the_same_small_files(spark, base):
    folder = f"{base}/run=000000000007"
    rows = small_hours(spark, 3, 50).repartition(2, "volume").sortWithinPartitions(*PARTITION_COLS)
    found = []
    for _ in range(2):
        write_small_files(rows, folder)
        found.append(sorted(str(path.relative_to(folder)) for path in Path(folder).rglob("*") if path.is_file()))
    assert found[0] == found[1] and len(found[0]) == 6
    assert bag(spark.read.schema(LAKE_SCHEMA).parquet(folder), *COLUMNS) == bag(rows, *COLUMNS)


def test_small_files_of_many_rows_are_written_in_groups(spark, base, monkeypatch):
    monkeypatch.setattr(small_files, "GROUP_BYTES", 4096)
    folder = f"{base}/run=000000000001"
    rows = small_hours(spark, 1, 25_000).coalesce(1).sortWithinPartitions(*PARTITION_COLS)
    write_small_files(rows, folder)
    (file,) = Path(folder).rglob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
    assert bag(spark.read.schema(LAKE_SCHEMA).parquet(folder), *COLUMNS) == bag(rows, *COLUMNS)


def test_small_files_keep_to_local_disks_and_plain_columns(spark, base):
    assert suits_small_files(spark, base, 512, LAKE_SCHEMA)
    assert not suits_small_files(spark, base, 1 << 30, LAKE_SCHEMA)
    assert not suits_small_files(spark, base, 512, StructType([*LAKE_SCHEMA.fields, StructField("n", ArrayType(LongType()))]))
    assert local_place(spark, "hdfs://127.0.0.1:1/lake") is None
    spark.conf.set("spark.sql.parquet.compression.codec", "lz4_raw")
    try:
        assert not suits_small_files(spark, base, 512, LAKE_SCHEMA)
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")


def test_a_damaged_file_holds_up_its_hour_of_small_files_only(spark, roots):
    raw, compacted = roots
    whole = next(Path(raw).rglob("hour=2/*.parquet"))
    whole.write_bytes(b"PAR1 this is not a Parquet file PAR1")
    whole.with_name(f".{whole.name}.crc").unlink(missing_ok=True)
    report = compact_partitions(spark, raw, compacted, DAY, max_file_bytes=512).collect()
    assert {r.partition[-6:]: r.status for r in report} == {"hour=1": "compacted", "hour=2": "failed"}
    assert len(list(Path(compacted).glob("run=*"))) == 1 and not list(Path(compacted).rglob("_temporary"))


def test_coarse_spec_is_the_union_of_its_hours(spark, roots, base):
    raw, compacted = roots
    compact_partitions(spark, raw, compacted, DAY)
    one_by_one = f"{base}/hours"
    compact_partitions(spark, raw, one_by_one, f"{DAY},hour=1;{DAY},hour=2")
    assert compacted_rows(spark, compacted) == compacted_rows(spark, one_by_one)
    assert data_files(compacted) == data_files(one_by_one)


def test_overlapping_and_padded_specs_do_not_duplicate(spark, roots):
    raw, compacted = roots
    compact_partitions(spark, raw, compacted, f"{DAY};year=2025,month=08,day=10,hour=01")
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw), *COLUMNS)


def test_other_hours_stay_untouched(spark, roots):
    raw, compacted = roots
    compact_partitions(spark, raw, compacted, DAY + ",hour=1")
    kept = {f.name for f in Path(compacted).rglob("hour=1/*.parquet")}
    compact_partitions(spark, raw, compacted, DAY + ",hour=2")
    assert {f.name for f in Path(compacted).rglob("hour=1/*.parquet")} == kept


def test_nothing_selected_changes_nothing(spark, roots):
    raw, compacted = roots
    assert compact_partitions(spark, raw, compacted, "").count() == 0
    report = compact_partitions(spark, raw, compacted, "year=1999").collect()
    assert [(r.partition, r.status) for r in report] == [("year=1999", "missing")]
    assert not Path(compacted).exists()


def test_missing_and_failed_specs_are_reported_and_raised(spark, roots):
    raw, compacted = roots
    for file in Path(raw).rglob("hour=2/*.parquet"):
        file.write_bytes(b"PAR1 this is not a Parquet file PAR1")
    specs = f"{DAY},hour=1;{DAY},hour=2;year=1999"
    report = {r.partition: r.status for r in compact_partitions(spark, raw, compacted, specs).collect()}
    assert report == {
        "year=2025/month=8/day=10/hour=1": "compacted",
        "year=2025/month=8/day=10/hour=2": "failed",
        "year=1999": "missing",
    }
    with pytest.raises(CompactionError, match="hour=2: failed"):
        compact_partitions(spark, raw, compacted, specs, raise_on_failure=True)


@pytest.mark.parametrize("spec", ["year=2025,month=8", "all", "hour=2;hour=1"])
def test_a_damaged_file_holds_up_its_hour_only(spark, roots, spec):
    raw, compacted = roots
    append(ticks(spark, hour_rows(7, 5)).repartition(1), raw)
    whole = next(Path(raw).rglob("hour=2/*.parquet"))
    whole.write_bytes(b"PAR1 this is not a Parquet file PAR1")
    whole.with_name(f".{whole.name}.crc").unlink(missing_ok=True)
    report = {r.partition[-6:]: r for r in compact_partitions(spark, raw, compacted, spec).collect()}
    assert report["hour=2"].status == "failed" and whole.name in report["hour=2"].message
    assert report["hour=1"].status == "compacted"
    assert ("hour=7" in report) == ("hour=1" not in spec)
    assert all(r.status == "compacted" for hour, r in report.items() if hour != "hour=2")
    assert not list(Path(compacted).rglob("hour=2"))


@pytest.mark.parametrize("max_file_bytes", [1 << 30, 700])
def test_rows_without_a_time_are_compacted_too(spark, roots, max_file_bytes):
    raw, compacted = roots
    append(ticks(spark, [("X", 1.0, 1, None)] * 300), raw)
    assert hours_needing_compaction(spark, raw, compacted).where("hour IS NULL AND raw_rows = 300").count() == 1
    report = compact_partitions(spark, raw, compacted, "all", max_file_bytes=max_file_bytes).collect()
    assert sorted((r.status, r.rows_after) for r in report) == [("compacted", 6), ("compacted", 6), ("compacted", 300)]
    assert compacted_rows(spark, compacted) == bag(read_ticks(spark, raw, LAKE_SCHEMA), *COLUMNS)
    assert hours_needing_compaction(spark, raw, compacted).count() == 0


def test_a_file_with_a_damaged_body_is_found(spark, roots):
    raw, compacted = roots
    append(ticks(spark, hour_rows(7, 60)).repartition(1), raw)
    file = next(Path(raw).rglob("hour=7/*.parquet"))
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    data = bytearray(file.read_bytes())
    data[4 : len(data) // 2] = bytes(len(data) // 2 - 4)
    file.write_bytes(data)
    report = {r.partition[-6:]: r for r in compact_partitions(spark, raw, compacted, DAY).collect()}
    assert report["hour=7"].status == "failed" and file.name in report["hour=7"].message
    assert report["hour=1"].status == report["hour=2"].status == "compacted"


def test_missing_raw_root_is_a_failure(spark, base):
    report = compact_partitions(spark, f"{base}/none", f"{base}/compacted", DAY).collect()
    assert [r.status for r in report] == ["failed"]


def test_verified_compaction(spark, roots, base):
    raw, compacted = roots
    done = compact_and_verify(spark, raw, compacted, DAY, f"{base}/snap", min_pct=50.0, strict=True)
    assert done.failures.count() == 0
    assert (done.before.count(), done.after.count()) == (4, 2)
    assert "snapshot_at" in done.before.columns
    with pytest.raises(CompactionCheckFailed, match="reduction_pct"):
        compact_and_verify(spark, raw, compacted, DAY, f"{base}/again", min_pct=60.0, per_partition=True)
    with pytest.raises(CompactionCheckFailed, match="missing"):
        compact_and_verify(spark, raw, compacted, "year=1999", f"{base}/none")


def test_growth_elsewhere_does_not_disturb_the_check(spark, roots, base):
    raw, compacted = roots
    append(ticks(spark, hour_rows(5, 40)).repartition(8), raw)
    done = compact_and_verify(spark, raw, compacted, DAY + ",hour=1", f"{base}/snap", strict=True)
    assert (done.before.count(), done.after.count()) == (2, 1)
