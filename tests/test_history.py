"""Snapshots kept over time, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tickharbor.operators import file_history, inventory_as_of, inventory_changes_between, keep_snapshot
from tickharbor.plans.maintenance import compact_and_verify

from .helpers import append, ticks

DAY = dt.datetime(2024, 5, 1)
SCHEMA = "key string, size bigint, last_modified timestamp"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Nine snapshots of a few files that come, grow, go and come back; the fifth is empty. They are kept out of order."""
    rng, root, snapshots = random.Random(3), str(tmp_path_factory.mktemp("history")), []
    for i in range(9):
        chosen = [] if i == 4 else rng.sample("abcdefgh", rng.randrange(3, 8))
        snapshots.append({key: (rng.choice([1, 1, 1, 2]), DAY) for key in chosen})
    for i in rng.sample(range(9), 9):
        files = [(key, *rest) for key, rest in snapshots[i].items()]
        keep_snapshot(spark.createDataFrame(files, SCHEMA).repartition(2), root, "lake", DAY + dt.timedelta(days=i))
    return snapshots, file_history(spark, root)


def test_as_of_any_time(kept):
    snapshots, history = kept
    for i, files in enumerate(snapshots):
        for hours in (0, 23):
            found = inventory_as_of(history, DAY + dt.timedelta(days=i, hours=hours)).collect()
            assert {r.key: r.size for r in found} == {key: size for key, (size, _) in files.items()} and len(found) == len(files)
    assert inventory_as_of(history, DAY - dt.timedelta(seconds=1)).count() == 0


def test_stays_do_not_touch_or_overlap(kept):
    snapshots, history = kept
    stays: dict[tuple, list] = {}
    for row in history.collect():
        stays.setdefault((row.key, row.size), []).append((row.valid_from, row.valid_to))
    for own in stays.values():
        own.sort()
        assert all(end is not None and end < begin for (_, end), (begin, _) in zip(own, own[1:]))
    changes = sum(key not in before or before[key] != files[key] for before, files in zip([{}, *snapshots], snapshots) for key in files)
    assert sum(map(len, stays.values())) == changes


@pytest.mark.parametrize("a, b", [(0, 8), (3, 4), (6, 2), (5, 5)])
def test_changes_between_any_two(kept, a, b):
    snapshots, history = kept
    found = inventory_changes_between(history, DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b, hours=5)).collect()
    before, after = snapshots[a], snapshots[b]
    expected = {}
    for key in before.keys() | after.keys():
        old, new = before.get(key), after.get(key)
        if old != new:
            change = "added" if old is None else "removed" if new is None else "size_changed"
            expected[key] = (change, old and old[0], new and new[0])
    assert {r.key: (r.change, r.size_before, r.size_after) for r in found} == expected


def test_every_verified_run_keeps_its_snapshots(spark, base):
    for run in range(3):
        append(ticks(spark, [("A", 1.0, run, f"2025-08-10 01:00:0{run}")]).coalesce(1), f"{base}/raw")
        done = compact_and_verify(spark, f"{base}/raw", f"{base}/compacted", "all", f"{base}/snap")
        assert (done.before.count(), done.after.count()) == (run + 1, 1)
    history = file_history(spark, f"{base}/snap/before")
    assert history.count() == 3 and history.where("valid_to IS NULL").count() == 3
    assert file_history(spark, f"{base}/snap/after").where("valid_to IS NOT NULL").count() == 2
