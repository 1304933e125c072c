"""Reports of batches against the messages they held, and messages that come again."""

from __future__ import annotations

import datetime as dt

import pytest

from tickharbor.sources import read_ticks, tick_source
from tickharbor.streaming import ingest_ticks, read_progress, recorded_progress, without_repeats

GOOD = '{"ticker":"%s","price":1.0,"volume":1,"timestamp":%d}'
AT = 1_754_800_000


def inbox(spark, base, *messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(f"{base}/inbox")


def ingest(spark, base, **options):
    messages = tick_source(spark, "files", path=f"{base}/inbox", max_files_per_trigger=1)
    roots = [f"{base}/{name}" for name in ("raw", "quarantine", "checkpoints")]
    ingest_ticks(messages, *roots, available_now=True, **options).awaitTermination()


def test_reports_of_two_runs_and_repeats_across_a_restart(spark, base):
    inbox(spark, base, GOOD % ("A", AT), GOOD % ("A", AT), GOOD % ("B", AT + 5), "no tick", "no tick")
    with recorded_progress(spark, f"{base}/progress"):
        ingest(spark, base, repeats_within="1 day")
    inbox(spark, base, GOOD % ("B", AT + 5), GOOD % ("B", AT - 999_999), "no tick", "another")
    with recorded_progress(spark, f"{base}/progress"):
        ingest(spark, base, repeats_within="1 day")
    ticks = read_ticks(spark, f"{base}/raw").orderBy("ts").collect()
    assert [(t.ticker, int(t.ts.timestamp()) - AT) for t in ticks] == [("B", -999_999), ("A", 0), ("B", 5)]
    assert read_ticks(spark, f"{base}/quarantine").count() == 2
    reports = read_progress(spark, f"{base}/progress").orderBy("batch").collect()
    # Batches without messages, in which a watermark advances, take a number and have no report.
    assert [(r.n_messages, r.n_bad) for r in reports] == [(3, 1), (2, 1)]
    assert len({r.query for r in reports}) == 1 and all(r.seconds > 0 for r in reports)
    assert reports[0].newest_ts == dt.datetime.fromtimestamp(AT + 5) and reports[0].lag_seconds > 0


def test_a_batch_without_good_messages_has_no_times(spark, base):
    inbox(spark, base, "no tick", "")
    with recorded_progress(spark, f"{base}/progress"):
        ingest(spark, base)
    (report,) = read_progress(spark, f"{base}/progress").collect()
    assert (report.n_messages, report.n_bad, report.newest_ts, report.lag_seconds) == (2, 2, None, None)


def test_an_error_inside_the_block_is_the_callers(spark, base):
    with pytest.raises(KeyError), recorded_progress(spark, f"{base}/progress"):
        raise KeyError("mine")


def test_repeats_on_a_batch_table(spark):
    rows = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "value string, n int")
    assert set(without_repeats(rows).columns) == {"value", "n"}
