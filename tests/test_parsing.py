import math

import pytest
from pyspark.sql import functions as F

from tickharbor.functions import (
    normalize_event_time,
    parse_ticks,
    split_bad_ticks,
    with_time_partitions,
)

NOTHING = (None, None, None, None)
NAN = float("nan")
CASES = [
    ("garbage", NOTHING, "malformed"),
    ("", NOTHING, "malformed"),
    (None, NOTHING, "malformed"),
    ("null", NOTHING, "malformed"),
    ('[{"ticker":"X","price":2,"volume":1,"timestamp":1}]', NOTHING, "malformed"),
    ('{"ticker":"X","price":"2.5","volume":1,"timestamp":1}', ("X", None, 1, 1.0), "malformed"),
    ('{"ticker":"X","price":2,"volume":1.0,"timestamp":1}', ("X", 2.0, None, 1.0), "malformed"),
    ('{"ticker":"X","price":2,"volume":1.7,"timestamp":1}', ("X", 2.0, None, 1.0), "malformed"),
    ('{"ticker":"X","price":2,"volume":3000000000,"timestamp":1}', ("X", 2.0, None, 1.0), "malformed"),
    ('{"ticker":"X","price":2,"volume":1,"timestamp":NaN}', ("X", 2.0, 1, NAN), "no_time"),
    ('{"ticker":"X","price":NaN,"volume":1,"timestamp":1}', ("X", NAN, 1, 1.0), "no_price"),
    ('{"ticker":"X","extra":9}', ("X", None, None, None), "no_price"),
    ('{"price":2,"volume":1,"timestamp":1}', (None, 2.0, 1, 1.0), "no_ticker"),
    ('{"ticker":"X","price":2,"volume":1}', ("X", 2.0, 1, None), "no_time"),
    ('{"ticker":"X","price":2,"volume":1,"timestamp":1e300}', ("X", 2.0, 1, 1e300), "no_time"),
    (
        '{"ticker":"X","price":2,"volume":1,"timestamp":"2025-01-01T00:00:00"}',
        ("X", 2.0, 1, None),
        "malformed",
    ),
    ('{"ticker":"X","price":2,"timestamp":1}', ("X", 2.0, None, 1.0), None),
    (
        '{"ticker":"AAPL","price":512.25,"volume":310,"timestamp":1754825099.5}',
        ("AAPL", 512.25, 310, 1754825099.5),
        None,
    ),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(None if text is None else bytearray(text.encode()),) for text, _, _ in CASES]
    return spark.createDataFrame(rows, "value binary").coalesce(1)


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_every_message_gives_the_expected_row(messages):
    rows = parse_ticks(messages).collect()
    assert len(rows) == len(CASES)
    for row, (text, expected, _) in zip(rows, CASES):
        assert all(same(a, b) for a, b in zip(row, expected)), text


def test_good_and_bad_make_up_the_input(messages):
    good, bad = split_bad_ticks(messages)
    assert good.count() == sum(reason is None for _, _, reason in CASES)
    assert [(r.message, r.reason) for r in bad.collect()] == [
        (text, reason) for text, _, reason in CASES if reason
    ]


def test_time_partitions(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 1, 1754825099.123456), ("A", 1.0, 1, NAN), ("A", 1.0, 1, None)],
        "ticker string, price double, volume int, timestamp double",
    )
    out = with_time_partitions(df)
    assert out.columns == ["ticker", "price", "volume", "ts", "year", "month", "day", "hour"]
    first, *rest = out.select(F.col("ts").cast("string"), "year", "month", "day", "hour").collect()
    assert tuple(first) == ("2025-08-10 11:24:59.123456", 2025, 8, 10, 11)
    assert all(tuple(r) == (None,) * 5 for r in rest)


def test_normalize_event_time_picks_the_first_candidate(spark):
    df = spark.sql(
        "SELECT 'A' AS ticker, timestamp'2020-01-01 00:00:00' AS ts, 1754825099.5D AS timestamp"
    )
    out = normalize_event_time(df)
    assert out.columns == ["ticker", "ts"]
    assert out.selectExpr("CAST(ts AS string)").first()[0] == "2025-08-10 11:24:59.5"


@pytest.mark.parametrize(
    "literal, expected",
    [
        ("'2025-08-10 11:24:59'", "2025-08-10 11:24:59"),
        ("'not a time'", None),
        ("1754825099L", "2025-08-10 11:24:59"),
        ("date'2025-08-10'", "2025-08-10 00:00:00"),
        ("timestamp_ntz'2025-08-10 11:24:59'", "2025-08-10 11:24:59"),
        ("double('NaN')", None),
    ],
)
def test_normalize_event_time_types(spark, literal, expected):
    out = normalize_event_time(spark.sql(f"SELECT {literal} AS event_time, 1 AS x"), name="timestamp")
    assert out.columns == ["timestamp", "x"]
    assert out.selectExpr("CAST(timestamp AS string)").first()[0] == expected


def test_normalize_event_time_needs_a_candidate(spark):
    with pytest.raises(ValueError, match="no event-time column"):
        normalize_event_time(spark.sql("SELECT 1 AS x"))
