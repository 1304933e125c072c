"""Batches and compaction runs count whole or not at all, and compacted hours are known without opening files."""

from __future__ import annotations

import time
from pathlib import Path

import pytest

from tickharbor.operators import compact_partitions
from tickharbor.plans.maintenance import hours_needing_compaction, tick_view
from tickharbor.schema import LAKE_SCHEMA, PARTITION_COLS
from tickharbor.sources import commits, read_partitions, read_ticks
from tickharbor.sources.commits import begin_batch, published_batches, remove_dead_batches, remove_dead_runs
from tickharbor.streaming.batches import place_batch, write_batch

from .helpers import append, bag, data_files, ticks

DAY = "year=2025,month=8,day=10"
COLUMNS = ("ticker", "price", "ts")


def rows(spark, *hours, ticker="A", n=3):
    return ticks(spark, [(ticker, float(i), i, f"2025-08-10 {h:02d}:00:{i:02d}") for h in hours for i in range(n)])


def seen(spark, root):
    return bag(read_ticks(spark, root, LAKE_SCHEMA), "ticker", "hour")


def put(spark, root, batch, *hours, ticker):
    write_batch(rows(spark, *hours, ticker=ticker).coalesce(1), root, batch, PARTITION_COLS)


def test_a_batch_that_dies_before_its_record_is_not_seen(spark, base, monkeypatch):
    put(spark, base, "q-7-0", 1, 2, ticker="A")
    first = {("A", 1): 3, ("A", 2): 3}
    create = commits.create_small

    def dies(spark, path, text):
        if "_open" not in path:
            raise RuntimeError("killed")
        return create(spark, path, text)

    for _ in range(2):
        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(commits, "create_small", dies)
            put(spark, base, "q-7-1", 2, 3, ticker="B")
        assert seen(spark, base) == first
    assert read_partitions(spark, base, DAY + ",hour=2", LAKE_SCHEMA).count() == 3
    put(spark, base, "q-7-1", 2, 3, ticker="B")
    both = {**first, ("B", 2): 3, ("B", 3): 3}
    assert seen(spark, base) == both and sum(data_files(base).values()) == 2 + 3 * 2
    put(spark, base, "q-7-1", 2, 3, ticker="B")  # run again after it was published
    assert seen(spark, base) == both and sum(data_files(base).values()) == 8
    assert remove_dead_batches(spark, base, 0) == 0
    assert remove_dead_batches(spark, base, int(time.time() * 1000) + 60_000) == 2
    assert seen(spark, base) == both and sum(data_files(base).values()) == 4
    assert published_batches(spark, base).dead == []


def test_a_batch_that_dies_after_its_record_counts(spark, base, monkeypatch):
    put(spark, base, "q-0", 1, ticker="A")
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):

        def dies(spark, path):
            raise RuntimeError("killed")

        patch.setattr(commits, "remove_folder", dies)
        put(spark, base, "q-1", 1, ticker="B")
    assert seen(spark, base) == {("A", 1): 3, ("B", 1): 3}
    put(spark, base, "q-1", 1, ticker="B")
    put(spark, base, "q-2", 1, ticker="C")
    assert seen(spark, base) == {("A", 1): 3, ("B", 1): 3, ("C", 1): 3}
    assert not list(Path(base, "_ingest/_open").glob("q*"))


def test_what_is_being_written_is_not_seen(spark, base):
    """Neither the next batch of a known query nor the first one of another."""
    put(spark, base, "q-0", 1, ticker="A")
    before = published_batches(spark, base)
    for batch in ("q-1", "other-0"):
        attempt = begin_batch(spark, base, batch, lambda a: place_batch(rows(spark, 5), base, a, PARTITION_COLS))
        Path(base, "_ingest/_open", attempt).unlink()  # as for a reader that looked before it was begun
        assert not before.counts(attempt) and seen(spark, base) == {("A", 1): 3}


def test_records_of_old_batches_are_not_kept_and_directories_without_attempts_count(spark, base, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_RECORDS", 3)
    place_batch(rows(spark, 1, ticker="old").coalesce(1), base, "legacy-4", PARTITION_COLS)
    for number in range(6):
        put(spark, base, f"q-{number}", 1, ticker="A")
    assert len(list(Path(base, "_ingest/q").glob("0*"))) == 3
    assert seen(spark, base) == {("old", 1): 3, ("A", 1): 18}


@pytest.fixture
def roots(spark, base):
    raw, compacted = f"{base}/raw", f"{base}/compacted"
    append(rows(spark, 1, 2, 3).coalesce(1), raw)
    compact_partitions(spark, raw, compacted, DAY, raise_on_failure=True)
    return raw, compacted


def test_a_run_that_dies_leaves_the_compacted_table_as_it_was(spark, roots, monkeypatch):
    raw, compacted = roots
    append(rows(spark, 1, 2, ticker="late").coalesce(1), raw)
    before = seen(spark, compacted)
    from tickharbor.operators import compaction

    def dies(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(compaction, "publish_run", dies)
        patch.setattr(compaction, "remove_folder", lambda *_: None)
        compact_partitions(spark, raw, compacted, DAY)
    assert seen(spark, compacted) == before and sum(data_files(compacted).values()) == 6
    assert read_partitions(spark, compacted, DAY + ",hour=1", LAKE_SCHEMA).count() == 3
    assert tick_view(spark, raw, compacted).count() == 15
    compact_partitions(spark, raw, compacted, f"{DAY},hour=1", raise_on_failure=True)
    assert seen(spark, compacted) == {**before, ("late", 1): 3}
    assert remove_dead_runs(spark, compacted, int(time.time() * 1000) + 60_000) == 1
    assert seen(spark, compacted) == {**before, ("late", 1): 3} and sum(data_files(compacted).values()) == 3


def test_two_runs_that_publish_at_once_both_stay(spark, roots, monkeypatch):
    raw, compacted = roots
    append(rows(spark, 1, 2, ticker="late").coalesce(1), raw)
    create, calls = commits.create_small, []

    def contended(spark, path, text):
        if "_versions" in path and not calls:
            calls.append(path)
            compact_partitions(spark, raw, compacted, f"{DAY},hour=2", raise_on_failure=True)
        return create(spark, path, text)

    monkeypatch.setattr(commits, "create_small", contended)
    compact_partitions(spark, raw, compacted, f"{DAY},hour=1", raise_on_failure=True)
    assert calls and seen(spark, compacted) == bag(read_ticks(spark, raw, LAKE_SCHEMA), "ticker", "hour")
    assert hours_needing_compaction(spark, raw, compacted).count() == 0


def test_kept_versions_stay_for_readers_that_have_begun(spark, roots):
    raw, compacted = roots
    begun = read_ticks(spark, compacted, LAKE_SCHEMA)
    append(rows(spark, 1, ticker="late").coalesce(1), raw)
    compact_partitions(spark, raw, compacted, DAY, keep_versions=2)
    assert begun.count() == 9 and read_ticks(spark, compacted, LAKE_SCHEMA).count() == 12
    compact_partitions(spark, raw, compacted, DAY, keep_versions=2)
    assert not Path(compacted, "run=000000000001").exists() and Path(compacted, "run=000000000002").exists()
    assert read_ticks(spark, compacted, LAKE_SCHEMA).count() == 12


def test_files_of_unchanged_hours_are_not_opened(spark, roots):
    raw, compacted = roots
    append(rows(spark, 2, ticker="late").coalesce(1), raw)
    for hour in (1, 3):
        (file,) = Path(raw).rglob(f"hour={hour}/*.parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"x" * file.stat().st_size)
    assert [tuple(r) for r in hours_needing_compaction(spark, raw, compacted).collect()] == [(2025, 8, 10, 2, 6, 3)]
    assert bag(tick_view(spark, raw, compacted), "ticker", "hour") == {("A", 1): 3, ("A", 2): 3, ("A", 3): 3, ("late", 2): 3}
    for root in roots:
        for file in Path(root).rglob("hour=3/*.parquet"):
            file.write_bytes(file.read_bytes() + b"longer")  # another size: another file
    assert hours_needing_compaction(spark, raw, compacted, DAY + ",hour=1").count() == 0


def test_an_hour_with_missing_rows_is_not_published(spark, roots, monkeypatch):
    raw, compacted = roots
    append(rows(spark, 1, 2, ticker="late").coalesce(1), raw)
    from tickharbor.operators import compaction

    write = compaction._write
    monkeypatch.setattr(compaction, "_write", lambda placed, *rest: write(placed.where("NOT (hour = 2 AND ticker = 'late')"), *rest))
    report = {r.partition[-1]: r.status for r in compact_partitions(spark, raw, compacted, DAY).collect()}
    assert report == {"1": "compacted", "2": "row_mismatch", "3": "compacted"}
    assert seen(spark, compacted) == {("A", 1): 3, ("A", 2): 3, ("A", 3): 3, ("late", 1): 3}
    assert tick_view(spark, raw, compacted).count() == 15
