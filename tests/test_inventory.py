import pytest

from tickharbor import operators as ops
from tickharbor.operators.inventory import CompactionCheckFailed
from tickharbor.sources import file_inventory, read_inventory

from .helpers import append, bag, ticks

FILES = [
    ("tick-lake/year=2025/month=8/day=10/hour=1/a.parquet", 1200),
    ("tick-lake/year=2025/month=8/day=10/hour=2/b.PARQUET", 800),
    ("tick-lake/date=2025-08-10/c.parquet", 50),
    ("tick-lake/loose.parquet", 10),
]


def inventory(spark, files):
    return spark.createDataFrame(files, "key string, size bigint")


@pytest.fixture
def files(spark):
    return inventory(spark, FILES)


def test_listing_takes_parquet_in_any_case_and_nothing_else(spark, base, tmp_path):
    for name, size in [
        ("year=2025/a.parquet", 3), ("year=2025/b.PARQUET", 5), ("c.parquet", 0),
        ("_temporary/e.parquet", 9), ("notes.txt", 4), ("d.parquet.crc", 1),
    ]:
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(b"x" * size)
    listed = {r.key.rsplit("/", 1)[1]: r.size for r in file_inventory(spark, base).collect()}
    assert listed == {"a.parquet": 3, "b.PARQUET": 5}
    assert file_inventory(spark, base, min_size=4).count() == 1
    assert file_inventory(spark, f"{base}/none").count() == 0


def test_summary(spark, files):
    assert tuple(ops.inventory_summary(files).first()) == (4, 2060)
    assert tuple(ops.inventory_summary(files.limit(0)).first()) == (0, 0)


def test_groups(files):
    assert [tuple(r) for r in ops.inventory_by_group(files, "tick-lake").collect()] == [
        ("ungrouped", 2, 60),
        ("year=2025", 2, 2000),
    ]
    dated = ops.inventory_by_group(files, "tick-lake", accept_date=True)
    assert [tuple(r) for r in dated.collect()] == [
        ("date=2025-08-10", 1, 50),
        ("ungrouped", 1, 10),
        ("year=2025", 2, 2000),
    ]


def test_prefix_is_not_part_of_the_label(spark):
    odd = inventory(spark, [("year=1999/lake/x.parquet", 1)])
    assert ops.inventory_by_group(odd, "year=1999/").first().label == "ungrouped"
    assert ops.inventory_by_group(odd).first().label == "year=1999"


def test_day_labels(spark, files):
    assert bag(ops.inventory_by_partition(files)) == {
        ("year=2025/month=8/day=10", 2): 1,
        ("ungrouped", 2): 1,
    }
    other = inventory(spark, [("myyear=1/month=8/x.parquet", 1), ("day=2/year=1/x.parquet", 1)])
    assert bag(ops.inventory_by_partition(other), "label") == {("month=8",): 1, ("day=2/year=1",): 1}


def test_largest(files):
    assert [r.size for r in ops.largest_files(files, 2).collect()] == [1200, 800]


def test_diff(spark, files):
    after = inventory(spark, [FILES[0], (FILES[1][0], 801), FILES[3], ("new.parquet", 1)])
    assert bag(ops.inventory_diff(files, after), "key", "change") == {
        (FILES[1][0], "size_changed"): 1,
        (FILES[2][0], "removed"): 1,
        ("new.parquet", "added"): 1,
    }
    assert ops.inventory_diff(files, files).count() == 0


def test_reduction(spark, files):
    after = inventory(spark, [FILES[0], ("year=2030/x.parquet", 1)])
    overall = ops.compaction_reduction(files, after).first()
    assert tuple(overall) == ("all", 4, 2, 50.0)
    per_day = ops.compaction_reduction(files, after, per_partition=True)
    assert bag(per_day, "label", "files_before", "files_after", "reduction_pct") == {
        ("year=2025/month=8/day=10", 2, 1, 50.0): 1,
        ("ungrouped", 2, 0, 100.0): 1,
    }


def test_assertions(spark, files):
    after, none = inventory(spark, [FILES[0]]), files.limit(0)
    assert ops.assert_compaction(files, after, 75.0).count() == 0
    assert ops.assert_compaction(files, after, 76.0).count() == 1
    failing = ops.assert_compaction(files, after, 60.0, per_partition=True).collect()
    assert [r.label for r in failing] == ["year=2025/month=8/day=10"]
    assert ops.assert_compaction(none, after, 50.0).count() == 0
    assert ops.assert_compaction(files, files).count() == 0
    assert ops.assert_compaction(files, files, strict=True).count() == 1
    assert ops.assert_compaction(after, files).count() == 1
    ops.require_compaction(ops.assert_compaction(files, after))
    with pytest.raises(CompactionCheckFailed, match="files_before"):
        ops.require_compaction(ops.assert_compaction(after, files))


def test_snapshot_roundtrip_and_real_diff(spark, base):
    lake = f"{base}/lake"
    append(ticks(spark, [("A", 1.0, 1, "2025-08-10 01:00:00")]), lake)
    ops.save_inventory(file_inventory(spark, lake), f"{base}/one", lake)
    append(ticks(spark, [("A", 1.0, 1, "2025-08-10 02:00:00")]), lake)
    ops.save_inventory(file_inventory(spark, lake), f"{base}/two", lake)
    one, two = read_inventory(spark, f"{base}/one"), read_inventory(spark, f"{base}/two")
    assert one.columns == ["key", "size", "last_modified", "snapshot_at", "base"]
    (added,) = ops.inventory_diff(one, two).collect()
    assert added.change == "added" and "/hour=2/" in added.key
