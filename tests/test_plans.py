"""The physical plans that the design relies on."""

import pytest

from tickharbor import operators as ops
from tickharbor.plans.registry import QUERIES, compacted_lake, files_after, files_before, ticks_of
from tickharbor.schema import LAKE_SCHEMA
from tickharbor.sources import read_ticks

from .helpers import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def df(spark):
    return ticks_of(spark, SF)


def test_only_needed_columns_are_read(df):
    text = plan(ops.ticker_summary(df))
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "partial_count" in text or "partial_avg" in text


def test_ticker_equality_reaches_the_reader(df):
    assert "EqualTo(event_type,purchase)" in plan(ops.daily_avg_price(df, "purchase"))


def test_counting_hours_reads_no_columns(spark):
    lake = read_ticks(spark, compacted_lake(spark, SF), LAKE_SCHEMA)
    assert "ReadSchema: struct<>" in plan(ops.ticks_by_partition(lake))


def test_newest_rows_are_a_top_k(df):
    text = plan(ops.latest_ticks(df, 5))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_tail_limits_before_each_shuffle(df):
    text = plan(ops.ticker_tail(df, 20), "simple")
    assert text.count("WindowGroupLimit") == 4
    assert text.index("Partial") > text.index("Exchange hashpartitioning(ticker")


def test_long_tails_are_limited_before_each_shuffle(df):
    assert plan(ops.ticker_tail(df, 5_000), "simple").count("WindowGroupLimit") == 4


def test_bands_do_not_shuffle_the_rows(df):
    text = plan(ops.price_bands(df), "simple")
    assert "BroadcastHashJoin" in text and "Window" not in text and "hashpartitioning" not in text


def test_inventory_diff_is_one_equi_join(spark):
    text = plan(ops.inventory_diff(files_before(spark, SF), files_after(spark, SF)), "simple")
    assert text.count("FullOuter") == 1


def test_no_query_needs_a_cross_join_or_python(spark):
    for name in ("price_bands", "inventory_diff", "compaction_reduction_by_day", "good_ticks", "ticker_tail"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
