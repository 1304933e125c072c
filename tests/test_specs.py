import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tickharbor.functions.partitions import (
    as_specs,
    format_spec,
    parse_partition_specs,
    partition_predicate,
    partition_spec_for,
)

numbers = st.fixed_dictionaries(
    {"year": st.integers(1970, 9999)},
    optional={"month": st.integers(1, 12), "day": st.integers(1, 31), "hour": st.integers(0, 23)},
)


def test_one_and_many():
    assert parse_partition_specs("year=2025,month=8,day=10") == [{"year": 2025, "month": 8, "day": 10}]
    assert parse_partition_specs("year=2025;year=2026,month=1") == [
        {"year": 2025},
        {"year": 2026, "month": 1},
    ]


def test_padding_does_not_matter():
    assert parse_partition_specs("year=2025,month=08,day=05") == parse_partition_specs(
        "year=2025,month=8,day=5"
    )


@pytest.mark.parametrize("text", ["", None, "  "])
def test_nothing_to_do(text):
    assert parse_partition_specs(text) == []


@pytest.mark.parametrize(
    "text",
    ["year=2025;", "year", "year=", "year=abc", "year=-1", "year=1,year=2", "week=3", "year=2025,,day=1"],
)
def test_malformed_is_rejected(text):
    with pytest.raises(ValueError, match="partition spec"):
        parse_partition_specs(text)


@given(st.lists(numbers, min_size=1, max_size=5))
def test_text_roundtrip(specs):
    assert parse_partition_specs(";".join(format_spec(s) for s in specs)) == specs


def test_as_specs_accepts_every_form():
    assert as_specs({"year": "08"}) == as_specs([{"year": 8}]) == as_specs("year=8")
    with pytest.raises(ValueError):
        as_specs([{"yaer": 8}])


def test_spec_of_a_run():
    when = dt.datetime(2025, 8, 5, 13, 59)
    assert partition_spec_for(when) == {"year": 2025, "month": 8, "day": 5}
    assert partition_spec_for(when, "hour")["hour"] == 13


def test_predicate(spark):
    hours = spark.range(0, 24 * 4).selectExpr(
        "2025 AS year", "8 AS month", "CAST(id DIV 24 + 1 AS INT) AS day", "CAST(id % 24 AS INT) AS hour"
    )
    specs = as_specs("year=2025,month=8,day=1;year=2025,month=8,day=3,hour=7")
    assert hours.where(partition_predicate(specs)).count() == 25
    assert hours.where(partition_predicate([])).count() == 0
    many = [{"day": d, "hour": h} for d in range(1, 5) for h in range(0, 24)]
    assert hours.where(partition_predicate(many)).count() == 96
