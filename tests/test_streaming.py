import json
from pathlib import Path

import pytest

from tickharbor.functions import parse_ticks, with_time_partitions
from tickharbor.operators import compact_partitions, latest_ticks
from tickharbor.schema import LAKE_SCHEMA
from tickharbor.sources import file_inventory, read_ticks, tick_source
from tickharbor.sources.stream import kafka_options
from tickharbor.streaming import (
    ingest_ticks,
    latest_ticks_stream,
    read_latest_ticks,
    read_window_stats,
    windowed_ticker_stats,
    write_tick_stream,
    write_window_stats,
)
from tickharbor.streaming.snapshots import KEPT, read_newest_snapshot, write_snapshot

from .helpers import bag, data_files

START = 1754825000  # 2025-08-10 11:23:20 UTC


def drop(inbox, name, *messages):
    """Put a file of messages into the inbox of a file source."""
    Path(inbox).mkdir(parents=True, exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    Path(inbox, name).write_text("\n".join(lines) + "\n")


def tick(second, ticker="AAPL", price=1.0):
    return {"ticker": ticker, "price": price, "volume": 1, "timestamp": START + second}


def run_ingest(spark, base):
    ingest_ticks(
        tick_source(spark, "files", path=f"{base}/inbox", max_files_per_trigger=1),
        f"{base}/raw",
        f"{base}/quarantine",
        f"{base}/checkpoints",
        available_now=True,
    ).awaitTermination()


def test_restarts_lose_and_repeat_nothing(spark, base):
    drop(f"{base}/inbox", "1", tick(0), tick(1), "garbage", {"ticker": "X"})
    run_ingest(spark, base)
    drop(f"{base}/inbox", "2", tick(2), tick(4000), '{"ticker":"X","price":1,"volume":1,"timestamp":NaN}')
    run_ingest(spark, base)
    run_ingest(spark, base)
    raw = read_ticks(spark, f"{base}/raw", LAKE_SCHEMA)
    messages = spark.read.text(f"{base}/inbox")
    batch = with_time_partitions(parse_ticks(messages)).where("price IS NOT NULL AND ts IS NOT NULL")
    assert bag(raw) == bag(batch) and raw.count() == 4
    bad = read_ticks(spark, f"{base}/quarantine")
    assert bag(bad, "reason") == {("malformed",): 1, ("no_price",): 1, ("no_time",): 1}
    assert {at.rpartition("/")[0] for at in data_files(f"{base}/raw")} == {f"year=2025/month=8/day=10/hour={h}" for h in (11, 12)}
    assert not list(Path(base).rglob("_spark_metadata"))


def test_a_repeated_batch_replaces_its_rows_and_another_checkpoint_does_not(spark, base):
    drop(f"{base}/inbox", "1", tick(0), tick(4000), "garbage")
    run_ingest(spark, base)
    drop(f"{base}/inbox", "2", tick(1))
    run_ingest(spark, base)
    before = bag(read_ticks(spark, f"{base}/raw", LAKE_SCHEMA))
    # As if the query had been lost after it wrote its last batch, before it noted that.
    for name in ("1", ".1.crc"):
        Path(f"{base}/checkpoints/ingest/commits/{name}").unlink()
    run_ingest(spark, base)
    assert bag(read_ticks(spark, f"{base}/raw", LAKE_SCHEMA)) == before and sum(before.values()) == 3
    assert read_ticks(spark, f"{base}/quarantine").count() == 1
    again = with_time_partitions(parse_ticks(tick_source(spark, "files", path=f"{base}/inbox"))).where("ts IS NOT NULL")
    write_tick_stream(again, f"{base}/raw", f"{base}/other", available_now=True).awaitTermination()
    assert read_ticks(spark, f"{base}/raw", LAKE_SCHEMA).count() == 6


def test_late_rows_go_to_their_own_hour_and_compaction_follows(spark, base):
    drop(f"{base}/inbox", "1", tick(0), tick(90_000))
    run_ingest(spark, base)
    drop(f"{base}/inbox", "2", tick(5))
    run_ingest(spark, base)
    raw = f"{base}/raw"
    assert read_ticks(spark, raw, LAKE_SCHEMA).where("day = 10 AND hour = 11").count() == 2
    assert file_inventory(spark, raw).count() == 3
    report = compact_partitions(spark, raw, f"{base}/compacted", "year=2025").collect()
    assert sorted((r.rows_after, r.files_after) for r in report) == [(1, 1), (2, 1)]
    drop(f"{base}/inbox", "3", tick(6))
    run_ingest(spark, base)
    assert read_ticks(spark, raw, LAKE_SCHEMA).count() == 4


def test_unpartitioned_sink(spark, base):
    drop(f"{base}/inbox", "1", tick(0), "garbage")
    parsed = parse_ticks(tick_source(spark, "files", path=f"{base}/inbox"))
    write_tick_stream(
        parsed, f"{base}/out", f"{base}/ckpt", partition_cols=(), available_now=True, query_name="flat"
    ).awaitTermination()
    assert bag(read_ticks(spark, f"{base}/out"), "ticker", "timestamp") == {
        ("AAPL", float(START)): 1,
        (None, None): 1,
    }


def test_processing_time_trigger_runs(spark, base):
    drop(f"{base}/inbox", "1", tick(0))
    ticks = with_time_partitions(parse_ticks(tick_source(spark, "files", path=f"{base}/inbox")))
    query = write_tick_stream(ticks, f"{base}/out", f"{base}/ckpt", trigger="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{base}/out").count() == 1


def streamed_ticks(spark, base):
    source = tick_source(spark, "files", path=f"{base}/inbox", max_files_per_trigger=1)
    return with_time_partitions(parse_ticks(source))


def test_closed_windows_equal_the_batch(spark, base):
    hours = [tick(3600 * h + 60 * m, t, float(m)) for h in range(5) for m in range(4) for t in ("A", "B")]
    drop(f"{base}/inbox", "1", *hours[:20])
    drop(f"{base}/inbox", "2", *hours[20:])
    stats = windowed_ticker_stats(streamed_ticks(spark, base), "1 hour", watermark="30 minutes")
    write_window_stats(stats, f"{base}/out", f"{base}/ckpt", available_now=True).awaitTermination()
    batch = windowed_ticker_stats(with_time_partitions(parse_ticks(spark.read.text(f"{base}/inbox"))), "1 hour")
    newest = START + 3600 * 4 + 180 - 1800
    closed = batch.where(f"unix_timestamp(window_end) <= {newest}")
    assert bag(spark.read.schema(stats.schema).parquet(f"{base}/out")) == bag(closed)
    assert 0 < closed.count() < batch.count()


def test_complete_mode_keeps_every_window(spark, base):
    drop(f"{base}/inbox", "1", tick(0, price=1.0), tick(4000, price=5.0))
    drop(f"{base}/inbox", "2", tick(30, price=3.0))
    stats = windowed_ticker_stats(streamed_ticks(spark, base), "1 hour", slide="30 minutes")
    write_window_stats(stats, f"{base}/out", f"{base}/ckpt", "complete", available_now=True).awaitTermination()
    batch = windowed_ticker_stats(
        with_time_partitions(parse_ticks(spark.read.text(f"{base}/inbox"))), "1 hour", "30 minutes"
    )
    assert bag(read_newest_snapshot(spark, f"{base}/out")) == bag(batch)
    with pytest.raises(ValueError):
        write_window_stats(stats, f"{base}/x", f"{base}/y", "replace")


def test_update_mode_shows_open_windows(spark, base):
    drop(f"{base}/inbox", "1", tick(0, price=1.0), tick(4000, price=5.0), tick(10, None, 2.0))
    drop(f"{base}/inbox", "2", tick(30, price=3.0))
    stats = windowed_ticker_stats(streamed_ticks(spark, base), "1 hour", watermark="2 hours")
    write_window_stats(stats, f"{base}/out", f"{base}/ckpt", "update", available_now=True).awaitTermination()
    batch = windowed_ticker_stats(with_time_partitions(parse_ticks(spark.read.text(f"{base}/inbox"))), "1 hour")
    assert bag(read_window_stats(spark, f"{base}/out")) == bag(batch) and batch.count() == 3


def test_newest_rows_follow_the_stream(spark, base):
    def refresh():
        latest_ticks_stream(
            streamed_ticks(spark, base), f"{base}/latest", f"{base}/ckpt", 3, available_now=True
        ).awaitTermination()
        return [r.price for r in read_latest_ticks(spark, f"{base}/latest", 3).collect()]

    for batch in range(10):
        drop(f"{base}/inbox", f"{batch}", tick(batch * 10, price=float(batch)), tick(-batch, price=-1.0))
    assert refresh() == [9.0, 8.0, 7.0]
    drop(f"{base}/inbox", "late", tick(-500, price=99.0))
    assert refresh() == [9.0, 8.0, 7.0]
    drop(f"{base}/inbox", "new", tick(500, price=42.0))
    assert refresh() == [42.0, 9.0, 8.0]
    everything = with_time_partitions(parse_ticks(spark.read.text(f"{base}/inbox")))
    assert [r.price for r in latest_ticks(everything, 3).collect()] == [42.0, 9.0, 8.0]


def test_a_repeated_batch_leaves_the_same_snapshot(spark, base):
    for batch_id, value in ((0, 1), (1, 2), (1, 2), (9, 3)):
        write_snapshot(spark.range(value), base, batch_id)
    assert read_newest_snapshot(spark, base).count() == 3


def test_snapshots_are_readable_while_others_are_written(spark, base):
    with pytest.raises(FileNotFoundError):
        read_newest_snapshot(spark, base)
    write_snapshot(spark.range(5), base, 0)
    reader = read_newest_snapshot(spark, base)
    for batch_id in range(1, KEPT):
        write_snapshot(spark.range(batch_id), base, batch_id)
    assert reader.count() == 5
    Path(f"{base}/batch={KEPT + 3}").mkdir()  # begun, not complete
    assert read_newest_snapshot(spark, base).count() == KEPT - 1
    write_snapshot(spark.range(1), base, KEPT)
    assert not Path(f"{base}/batch=0").exists() and Path(f"{base}/batch=1").exists()


def test_kafka_options():
    assert kafka_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "stock-ticks",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    options = kafka_options("b", "t", "earliest", False, max_offsets_per_trigger=10, min_partitions=4)
    assert options["failOnDataLoss"] == "false"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("10", "4")


def test_unknown_sources_are_rejected(spark):
    with pytest.raises(ValueError):
        tick_source(spark, "files")
    with pytest.raises(ValueError):
        tick_source(spark, "socket")
