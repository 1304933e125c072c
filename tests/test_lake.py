import datetime as dt
import os
import time
from pathlib import Path

import pytest

from tickharbor.operators import save_table
from tickharbor.schema import LAKE_SCHEMA, PARTITION_COLS
from tickharbor.scratch import shared_dir, stage
from tickharbor.sources import (
    read_latest_files,
    read_legacy_ticks,
    read_partitions,
    read_ticks,
    ticks_since,
    union_ticks,
)

from .helpers import append, bag, data_files, plan, ticks


@pytest.fixture
def lake(spark, base):
    path = f"{base}/lake"
    rows = [("A", float(h), h, f"2025-08-{d:02d} {h:02d}:30:00") for d in (9, 10) for h in (2, 9, 23)]
    append(ticks(spark, rows).coalesce(1), path)
    return path


def test_partitions_are_pruned_and_compared_as_numbers(spark, lake):
    df = read_partitions(spark, lake, "year=2025,month=08,day=09,hour=09", LAKE_SCHEMA)
    assert [r.price for r in df.collect()] == [9.0]
    text = plan(df)
    assert "PartitionFilters: [isnotnull(year" in text and "(hour#" in text
    assert read_partitions(spark, lake, "year=2025,day=10").count() == 3


def test_inferred_and_given_schema_agree(spark, lake):
    assert bag(read_ticks(spark, lake)) == bag(read_ticks(spark, lake, LAKE_SCHEMA))


def test_since_prunes_directories_and_reaches_the_reader(spark, lake):
    df = ticks_since(read_ticks(spark, lake), "2025-08-10 09:30:00")
    assert sorted(r.hour for r in df.collect()) == [9, 23]
    text = plan(df)
    assert "coalesce" in text.split("PartitionFilters")[1].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in text


def test_since_reads_naive_times_in_the_session_zone(spark, lake):
    df = read_ticks(spark, lake)
    naive = dt.datetime(2025, 8, 10, 9, 30)
    east = naive.replace(tzinfo=dt.timezone(dt.timedelta(hours=-1)))
    assert ticks_since(df, naive).count() == 2
    assert ticks_since(df, east).count() == 1


def test_latest_by_name_orders_hours_as_numbers(spark, lake):
    df = read_latest_files(spark, lake, 2, by="name")
    assert sorted((r.day, r.hour) for r in df.collect()) == [(10, 9), (10, 23)]


def test_latest_by_mtime_skips_empty_files(spark, lake):
    chosen = next(Path(lake).glob("year=2025/month=8/day=9/hour=2/*.parquet"))
    now = time.time()
    os.utime(chosen, (now + 100, now + 100))
    empty = chosen.with_name("newest-but-empty.parquet")
    empty.touch()
    os.utime(empty, (now + 200, now + 200))
    row = read_latest_files(spark, lake, 1).collect()
    assert [(r.day, r.hour, r.price) for r in row] == [(9, 2, 2.0)]


def test_latest_of_nothing(spark, base):
    with pytest.raises(FileNotFoundError):
        read_latest_files(spark, f"{base}/none")
    assert read_latest_files(spark, f"{base}/none", 10, by="name").count() == 0
    with pytest.raises(ValueError):
        read_latest_files(spark, base, by="size")


def test_latest_files_are_combined_by_column_name(spark, base):
    spark.sql("SELECT 'A' AS ticker, 1.0D AS price").write.parquet(f"{base}/t")
    spark.sql("SELECT 2.0D AS price, 'B' AS ticker, 7 AS volume").write.mode("append").parquet(f"{base}/t")
    got = bag(read_latest_files(spark, f"{base}/t", 10, by="name"), "ticker", "price", "volume")
    assert got == {("A", 1.0, None): 1, ("B", 2.0, 7): 1}


def test_legacy_and_current_tables_together(spark, lake, base):
    old = spark.createDataFrame(
        [("L", 1.0, 1, 1754825099.5)], "ticker string, price double, volume int, timestamp double"
    )
    save_table(old, f"{base}/old")
    both = union_ticks(read_ticks(spark, lake), read_legacy_ticks(spark, f"{base}/old"))
    assert both.columns == LAKE_SCHEMA.fieldNames()
    assert both.count() == 7 and both.where("hour = 11").count() == 1
    raw = union_ticks(read_ticks(spark, lake), spark.read.parquet(f"{base}/old"))
    assert raw.where("ts IS NULL AND timestamp IS NOT NULL").count() == 1


def test_save_table_replaces(spark, base):
    for value in (1, 2):
        save_table(spark.range(value), f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 2


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(3), "test")
    assert staged.count() == 3
    assert all(f"{shared_dir(spark)}/tickharbor/test-" in f for f in staged.inputFiles())


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})()


def test_shared_folder_is_the_configured_one_and_never_local_on_a_cluster():
    assert shared_dir(Session("yarn", "s3a://lake/checkpoints/")) == "s3a://lake/checkpoints"
    assert shared_dir(Session("local[2]")) == shared_dir(Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://master:7077"))


def test_gathered_writes_bound_the_files_of_a_hot_partition(spark, base):
    rows = [("HOT", float(i), i, "2025-08-09 02:30:00") for i in range(400)]
    rows += [("A", 1.0, 1, f"2025-08-09 {h:02d}:00:00") for h in range(24)]
    df = ticks(spark, rows).repartition(40)
    save_table(df, f"{base}/plain", PARTITION_COLS)
    save_table(df, f"{base}/spread", PARTITION_COLS, spread=3)
    assert bag(read_ticks(spark, f"{base}/spread")) == bag(df)
    plain, spread = data_files(f"{base}/plain"), data_files(f"{base}/spread")
    assert max(plain.values()) > 30 and 1 < max(spread.values()) <= 3


def test_only_selected_directories_are_listed(spark, lake):
    def listed(specs):
        files = read_partitions(spark, lake, specs, LAKE_SCHEMA).inputFiles()
        return {f.split("/hour=")[0][-6:] + f.split("/hour=")[1].split("/")[0] for f in files}

    every = read_ticks(spark, lake, LAKE_SCHEMA)
    hour = every.select("year", "month", "day", "hour").where("hour IS NOT NULL").first().asDict()
    assert len(listed(hour)) == 1
    for specs in (hour, [hour, {"year": hour["year"]}], {"hour": hour["hour"]}, {"year": 1900}, {}):
        chosen = [specs] if isinstance(specs, dict) else specs
        want = sum(all(r[k] == v for k, v in chosen[-1].items()) for r in every.collect())
        assert read_partitions(spark, lake, specs, LAKE_SCHEMA).count() == want
