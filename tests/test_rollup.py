"""Answers from kept states against the rows, and what an answer has to scan."""

from __future__ import annotations

from pathlib import Path

import pytest

from tickharbor.operators import compact_partitions, ticker_summary
from tickharbor.operators.states import merge_states, price_states, ticker_summary_of
from tickharbor.plans import rollup as rollups
from tickharbor.plans.maintenance import tick_view
from tickharbor.plans.rollup import lake_states, update_rollup

from .helpers import append, bag, ticks

DAY = "year=2025,month=8,day=10"


def rows(spark, *hours, ticker="A", price=1.0, n=3):
    return ticks(spark, [(ticker, price + i, i, f"2025-08-10 {h:02d}:00:{i:02d}") for h in hours for i in range(n)])


class Lake:
    def __init__(self, spark, base):
        self.spark, self.roots = spark, tuple(f"{base}/{name}" for name in ("raw", "compacted", "rollup"))
        self.raw, self.compacted, self.rollup = self.roots

    def compact(self, specs=DAY):
        compact_partitions(self.spark, self.raw, self.compacted, specs, raise_on_failure=True)

    def update(self, **options):
        return update_rollup(self.spark, self.compacted, self.rollup, **options)

    def states(self, specs=None):
        return lake_states(self.spark, *self.roots, specs=specs)

    def scanned(self):
        """The roots below which an answer has files to open."""
        files = [f for f in self.states().inputFiles()]
        return {name for name in ("raw", "compacted", "rollup") if any(f"/{name}/" in f for f in files)}

    def agrees(self):
        expected = bag(ticker_summary(tick_view(self.spark, self.raw, self.compacted)))
        return expected and bag(ticker_summary_of(self.states())) == expected


@pytest.fixture
def lake(spark, base):
    lake = Lake(spark, base)
    append(rows(spark, 1, 2, 3).unionByName(rows(spark, 1, ticker="B", price=5.0)), lake.raw)
    append(ticks(spark, [(None, 2.0, 1, "2025-08-10 02:00:00"), ("C", None, 1, "2025-08-10 02:30:00")]), lake.raw)
    return lake


def test_states_merge_like_their_rows(spark):
    table = rows(spark, 1, 2).unionByName(ticks(spark, [("A", None, 1, "2025-08-10 01:00:00"), (None, 4.0, 1, None)]))
    fine = price_states(table, "hour", "ticker")
    assert bag(merge_states(fine, "ticker")) == bag(price_states(table, "ticker"))
    assert bag(ticker_summary_of(fine)) == bag(ticker_summary(table))


def test_life_of_a_rollup(spark, lake):
    assert lake.update() == 0 and lake.agrees()  # nothing compacted
    lake.compact()
    assert lake.agrees()  # nothing rolled up
    assert (lake.update(), lake.update()) == (3, 0)
    assert lake.agrees() and "compacted" not in lake.scanned()
    append(rows(spark, 2, ticker="B", price=70.0), lake.raw)  # late
    append(rows(spark, 5, ticker="D"), lake.raw)  # new
    assert lake.agrees() and "compacted" not in lake.scanned()
    lake.compact(DAY + ",hour=2")
    assert lake.agrees() and "compacted" in lake.scanned()
    assert lake.update() == 1
    assert lake.agrees() and "compacted" not in lake.scanned()
    assert {r.hour for r in lake.states(DAY + ",hour=2").collect()} == {2}


def test_rows_without_a_time(spark, lake):
    append(ticks(spark, [("A", 9.0, 1, None), ("Z", 1.0, 1, None)]), lake.raw)
    lake.compact("all")
    assert lake.update() == 4 and lake.agrees()
    assert {(r.hour_key, r.hour) for r in lake.states().where("ticker = 'Z'").collect()} == {(-1, None)}


def test_an_update_that_dies_does_not_count(spark, lake, monkeypatch):
    lake.compact()

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(rollups, "create_small", dies)
        lake.update()
    assert lake.agrees() and "rollup" not in lake.scanned()
    assert lake.update() == 3 and lake.agrees()


def test_another_update_publishes_first(spark, lake, monkeypatch):
    lake.compact()
    create, raced = rollups.create_small, []

    def late(spark, path, text):
        if not raced:
            raced.append(True)
            assert lake.update() == 3
        return create(spark, path, text)

    monkeypatch.setattr(rollups, "create_small", late)
    assert lake.update() == 3
    assert lake.agrees() and "compacted" not in lake.scanned()


def test_folders_stay_few_and_old_states_go(spark, lake):
    def folders():
        return len(list(Path(lake.rollup).glob("states-*")))

    for hour in (1, 2, 3):
        lake.compact(f"{DAY},hour={hour}")
        assert lake.update(max_folders=2) == 1 and lake.agrees()
    assert folders() == 1
    lake.compact()
    assert lake.update(max_folders=2) == 3 and lake.agrees() and folders() == 1
    assert len(list(Path(f"{lake.rollup}/_versions").glob("0*"))) == 1
