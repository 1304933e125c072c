"""Which compacted files a lookup opens, and that no row is missed."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickharbor.operators import compact_partitions
from tickharbor.plans import file_index
from tickharbor.plans.file_index import can_hold, ticks_of, update_file_index
from tickharbor.plans.maintenance import tick_view

from .helpers import append, bag, ticks

DAY = "year=2025,month=8,day=10"


class Lake:
    def __init__(self, spark, base):
        self.spark, self.roots = spark, tuple(f"{base}/{name}" for name in ("raw files", "compacted files", "index"))
        self.raw, self.compacted, self.index = self.roots

    def add(self, *rows):
        append(ticks(self.spark, list(rows)), self.raw)

    def compact(self, specs="all", **options):
        compact_partitions(self.spark, self.raw, self.compacted, specs, raise_on_failure=True, **options)

    def update(self, **options):
        return update_file_index(self.spark, self.compacted, self.index, **options)

    def find(self, *tickers, **bounds):
        return ticks_of(self.spark, *self.roots, list(tickers), **bounds)

    def agrees(self, *tickers, condition="true"):
        names = ", ".join(f"'{t}'" for t in tickers)
        view = tick_view(self.spark, self.raw, self.compacted)
        expected = bag(view.where(f"ticker IN ({names})").where(condition))
        return expected, bag(self.find(*tickers))

    def opened(self, *tickers, **bounds):
        """Hours of the compacted files that a lookup opens."""
        files = self.find(*tickers, **bounds).inputFiles()
        return sorted(f.split("hour=")[1].split("/")[0] for f in files if "compacted" in f)


def row(ticker, hour, price=1.0, minute=0):
    return (ticker, price, 1, f"2025-08-10 {hour:02d}:{minute:02d}:00")


@pytest.fixture
def lake(spark, base):
    lake = Lake(spark, base)
    lake.add(*[row("A", h, float(h)) for h in range(1, 6)], row("B", 2), row("B", 4, 2.0, 30), row(None, 3), row("", 5))
    lake.compact()
    return lake


def test_only_files_that_hold_the_ticker_are_opened(lake):
    assert lake.opened("B") == ["1", "2", "3", "4", "5"]  # not indexed
    assert (lake.update(), lake.update()) == (5, 0)
    assert lake.opened("A") == ["1", "2", "3", "4", "5"]
    assert lake.opened("B") == ["2", "4"] and lake.opened("") == ["5"] and lake.opened("Z") == []
    assert lake.opened("B", "") == ["2", "4", "5"]
    for wanted in (("A",), ("B",), ("",), ("B", "A", "B"), ("Z", "B")):
        expected, found = lake.agrees(*wanted)
        assert expected == found and found
    assert lake.find("Z").count() == 0


def test_times_skip_files_too(lake):
    lake.update()
    assert lake.opened("A", since="2025-08-10 03:00:00", until="2025-08-10 05:00:00") == ["3", "4"]
    assert lake.opened("B", since="2025-08-10 04:30:01") == []
    found = lake.find("A", since="2025-08-10 03:00:00", until="2025-08-10 05:00:00")
    assert {r.hour for r in found.collect()} == {3, 4}
    assert lake.find("B", since="2025-08-10 04:30:00").count() == 1
    assert lake.find("A", specs=f"{DAY},hour=2").count() == 1


def test_late_rows_new_hours_and_runs(lake):
    lake.update()
    lake.add(row("B", 3), row("C", 9))  # a late row, and an hour that is open
    for ticker in "ABC":
        expected, found = lake.agrees(ticker)
        assert expected == found and found
    lake.compact(f"{DAY},hour=3")
    assert lake.agrees("B")[0] == lake.agrees("B")[1]
    assert lake.update() == 1
    assert lake.opened("B") == ["2", "3", "4"] and lake.find("B").count() == 3 and lake.find("C").count() == 1


def test_rows_without_a_time_or_any_ticker(lake):
    lake.add(("N", 1.0, 1, None), (None, 1.0, 1, "2025-08-10 07:00:00"))
    lake.compact()
    assert lake.update() == 7
    assert lake.opened("N") == ["__HIVE_DEFAULT_PARTITION__"] and lake.find("N").count() == 1
    assert lake.find("N", since="2020-01-01").count() == 0


def test_files_with_many_tickers_get_several_filters(spark, lake, monkeypatch):
    monkeypatch.setattr(file_index, "TICKERS_PER_FILTER", 50)
    lake.add(*[row(f"T{i}", 2, minute=i % 60) for i in range(700)])
    lake.compact(num_files=2)
    assert lake.update() == 5
    table = spark.read.parquet(*[str(p) for p in Path(lake.index).glob("states-*")])
    assert table.where("hour_key = 2025081002").agg({"n_filters": "min"}).first()[0] >= 6
    filters = table.where("hour_key = 2025081002")
    holding = {f"{kind}{i}": F.max(can_hold(f"{kind}{i}")) for kind in "TU" for i in range(0, 700, 28)}
    held = filters.agg(*[column.alias(name) for name, column in holding.items()]).first().asDict()
    assert all(held[name] for name in held if name.startswith("T"))
    assert sum(held[name] for name in held if name.startswith("U")) <= 3
    assert lake.find("T5", "T699").count() == 2


def test_no_index_no_compaction_and_bad_arguments(spark, base):
    lake = Lake(spark, base)
    lake.add(row("A", 1))
    assert lake.update() == 0 and lake.find("A").count() == 1
    for wanted in ([], [None], ["A", None]):
        with pytest.raises(ValueError):
            ticks_of(spark, *lake.roots, wanted)


def test_folders_are_gathered(lake):
    lake.update()
    for hour in (1, 2, 3):
        lake.compact(f"{DAY},hour={hour}")
        assert lake.update(max_folders=2) == 1
    assert lake.opened("B") == ["2", "4"]
    expected, found = lake.agrees("A")
    assert expected == found
