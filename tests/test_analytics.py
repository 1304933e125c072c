import datetime as dt
import random
from collections import defaultdict

import pytest

from tickharbor import operators as ops
from tickharbor.sources import ticks_since

from .helpers import append, bag, plan, ticks


@pytest.fixture(scope="module")
def rows():
    """Skewed ticks: one ticker holds most rows, many of them identical; some keys are NULL."""
    rng = random.Random(7)
    made = []
    for i in range(600):
        ticker = "HOT" if rng.random() < 0.6 else rng.choice(["A", "B", None])
        at = None if rng.random() < 0.03 else f"2025-08-{rng.randint(1, 4):02d} {rng.randint(0, 23):02d}:00:{rng.randint(0, 5):02d}"
        made.append((ticker, float(rng.randint(1, 30)), rng.randint(1, 3), at))
    return made + [("HOT", 5.0, 1, "2025-08-04 23:59:59")] * 200


@pytest.fixture(scope="module")
def df(spark, rows):
    return ticks(spark, rows).repartition(6).cache()


def test_tail_equals_a_plain_sort(df, rows):
    by_ticker = defaultdict(list)
    for ticker, price, volume, at in rows:
        by_ticker[ticker].append((at or "", price, volume))
    expected = sorted(
        (str(ticker), rank, *row)
        for ticker, group in by_ticker.items()
        for rank, row in enumerate(sorted(group, reverse=True)[:7], 1)
    )
    got = ops.ticker_tail(df, 7, splits=3).selectExpr(
        "coalesce(ticker, 'None')", "rank", "coalesce(CAST(ts AS string), '')", "price", "volume"
    )
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_tail_of_one_ticker(df):
    assert bag(ops.ticker_tail(df, 7, "A")) == bag(ops.ticker_tail(df, 7).where("ticker = 'A'"))


def test_bands_keep_every_row_and_null_tickers(df, rows):
    out = ops.price_bands(df)
    assert bag(out, *df.columns) == bag(df, *df.columns)
    prices = [p for t, p, _, _ in rows if t is None]
    band = out.where("ticker IS NULL").select("min_price", "max_price", "avg_price").distinct().collect()
    assert [tuple(b) for b in band] == [(min(prices), max(prices), pytest.approx(sum(prices) / len(prices)))]


def test_bands_without_broadcast_are_the_same(spark, df):
    expected = bag(ops.price_bands(df))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ops.price_bands(df)
        assert "SortMergeJoin" in plan(out)
        assert bag(out) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_trend_drops_null_keys(df):
    expected = df.where("ticker IS NOT NULL AND ts IS NOT NULL").select("ticker", "ts").distinct().count()
    assert ops.price_trend(df).count() == expected


def test_ticker_list(df):
    assert bag(ops.ticker_list(df)).keys() == {("A",), ("B",), ("HOT",)}
    assert bag(ops.ticker_list(df, keep_null=True)).keys() == {("A",), ("B",), ("HOT",), (None,)}


def test_latest_and_recent_agree(spark, df, base):
    append(df, base)
    lake = spark.read.parquet(base)
    as_of = dt.datetime(2025, 8, 5, tzinfo=dt.timezone.utc)
    for n in (1, 5, 150, 10_000):
        expected = bag(ops.latest_ticks(lake, n), "ticker", "price", "ts", "volume")
        assert bag(ops.latest_ticks_recent(lake, n, as_of), "ticker", "price", "ts", "volume") == expected


def test_recent_reads_only_the_newest_hours(spark, df, base):
    append(df, base)
    lake = spark.read.parquet(base)
    recent = ops.latest_ticks_recent(lake, 3, dt.datetime(2025, 8, 5, tzinfo=dt.timezone.utc))
    assert "PartitionFilters: [(coalesce" in plan(recent)


def test_since_is_exact_within_an_hour(df):
    since = "2025-08-02 10:00:03"
    assert bag(ticks_since(df, since)) == bag(df.where(f"ts >= timestamp'{since}'"))


def test_counts(df, rows):
    assert ops.tick_count(df).first().asDict() == {"total_records": len(rows), "is_empty": False}
    assert ops.tick_count(df.limit(0)).first().is_empty
    top = ops.record_count_by_ticker(df, top=1).collect()
    assert [r.ticker for r in top] == ["HOT"]


def test_preview_is_bounded(df):
    assert ops.preview(df, 4).count() == 4
    assert ops.preview(df, 4).columns == ["ticker", "price", "ts", "volume"]
