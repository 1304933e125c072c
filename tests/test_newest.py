"""The newest rows and files of a lake, found without listing old directories."""

from __future__ import annotations

import pytest

from tickharbor.operators import compact_partitions, latest_ticks, latest_ticks_at
from tickharbor.schema import LAKE_SCHEMA, PARTITION_COLS
from tickharbor.sources import newest, read_latest_files, read_ticks
from tickharbor.streaming.batches import write_batch
from tickharbor.streaming.runs import covering, read_changes, write_changes

from .helpers import append, ticks


@pytest.fixture
def lake(spark, base):
    days = [("A", float(d), d, f"2024-{m:02d}-{d:02d} {h:02d}:00:00") for m in (2, 10, 11) for d in (3, 9, 21) for h in (5, 11)]
    append(ticks(spark, [*days, ("N", 1.0, 1, None)]).coalesce(1), f"{base}/raw")
    return f"{base}/raw"


@pytest.fixture
def listed(monkeypatch):
    """Folders that were listed."""
    seen, list_folder = [], newest.children

    def children(spark, folder):
        seen.append(folder)
        return list_folder(spark, folder)

    monkeypatch.setattr(newest, "children", children)
    return seen


@pytest.mark.parametrize("n", [1, 3, 7, 18, 19, 50])
def test_newest_rows_are_those_of_the_whole_table(spark, lake, n):
    expected = latest_ticks(read_ticks(spark, lake, LAKE_SCHEMA), n).collect()
    assert latest_ticks_at(spark, lake, n).collect() == expected


def test_old_days_are_not_listed(spark, lake, listed):
    assert latest_ticks_at(spark, lake, 2).count() == 2
    assert listed and all(f.endswith("raw") or "year=2024" in f for f in listed)
    below = [f.split("year=2024/")[1] for f in listed if "year=2024/" in f]
    # Two rounds take up to five hours: three days of the last month, and no other month.
    assert below and all(f.startswith("month=11") for f in below)
    listed.clear()
    assert read_latest_files(spark, lake, 2, "name", LAKE_SCHEMA).count() == 2
    assert not any("month=10" in f or "month=2" in f or "day=9" in f for f in listed)


def test_empty_newest_hours_are_passed_over(spark, lake, base):
    for hour in (7, 8, 9):
        folder = f"{lake}/year=2025/month=1/day=2/hour={hour}"
        ticks(spark, [("A", 1.0, 1, "2025-01-02 07:00:00")]).limit(0).drop(*PARTITION_COLS).coalesce(1).write.parquet(folder)
    expected = latest_ticks(read_ticks(spark, lake, LAKE_SCHEMA), 5).collect()
    assert len(expected) == 5 and latest_ticks_at(spark, lake, 5).collect() == expected


def test_compacted_and_streamed_roots(spark, lake, base, listed):
    compact_partitions(spark, lake, f"{base}/compacted", "all", raise_on_failure=True)
    expected = latest_ticks(read_ticks(spark, lake, LAKE_SCHEMA), 4).collect()
    assert latest_ticks_at(spark, f"{base}/compacted", 4).collect() == expected and not listed
    assert read_latest_files(spark, f"{base}/compacted", 3, "name", LAKE_SCHEMA).count() == 3
    for number in range(2):
        write_batch(read_ticks(spark, lake, LAKE_SCHEMA), f"{base}/stream", f"q-{number}", PARTITION_COLS)
    twice = read_ticks(spark, f"{base}/stream", LAKE_SCHEMA)
    assert latest_ticks_at(spark, f"{base}/stream", 5).collect() == latest_ticks(twice, 5).collect()
    assert read_latest_files(spark, f"{base}/stream", 3, "name", LAKE_SCHEMA).count() == 3


def test_roots_without_hours(spark, base):
    assert latest_ticks_at(spark, f"{base}/none").count() == 0
    ticks(spark, [("A", 1.0, 1, "2025-01-02 07:00:00")]).write.parquet(f"{base}/flat")
    assert latest_ticks_at(spark, f"{base}/flat").count() == 1


def test_runs_cover_every_batch_once_and_stay_few():
    for fan in (2, 4, 16):
        for last in range(300):
            runs = covering(last, fan)
            batches = [b for level, number in runs for b in range(number * fan**level, (number + 1) * fan**level)]
            assert batches == list(range(last + 1))
            levels = [level for level, _ in runs]
            assert all(levels.count(level) < fan for level in levels) and levels == sorted(levels, reverse=True)
    assert max(len(covering(last)) for last in range(200)) <= 2 * 15


def test_merged_changes_equal_the_last_of_each_key(spark, base):
    expected, files = {}, []
    for batch in range(23):
        own = {(batch * 7 + i) % 11: batch * 100 + i for i in range(batch % 4)}
        expected.update(own)
        changes = spark.createDataFrame(list(own.items()), "key int, value int").coalesce(1)
        write_changes(changes, base, batch, ["key"], fan=3)
        if batch in (5, 13):
            write_changes(changes, base, batch, ["key"], fan=3)  # run again after it was published
        if batch % 5 == 2:
            found = read_changes(spark, base, ["key"], fan=3)
            assert {r.key: r.value for r in found.collect()} == expected and found.columns == ["key", "value"]
            files.append(len(found.inputFiles()))
    assert max(files) <= 3 * 2
    with pytest.raises(FileNotFoundError):
        read_changes(spark, f"{base}/none", ["key"])
