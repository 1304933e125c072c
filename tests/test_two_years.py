"""Lake queries over events of two years in several input files, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from tests.oracle import differences
from tickharbor.plans.oracles import ORACLES
from tickharbor.plans.registry import QUERIES

LAKE_QUERIES = [
    "compacted_rows", "repeated_compaction", "latest_ticks_recent", "latest_ticks_by_path", "last_files_by_name", "ticks_view_late",
    "ticks_view", "lake_inventory", "compaction_report", "verified_compaction", "ticks_after_dead_batch",
]


@pytest.fixture(scope="module")
def two_years(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("two-years"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    moved = events.selectExpr(
        "event_id", "CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 YEAR ELSE ts END AS ts",
        "user_id", "event_type", "value", "props",
    )
    moved.repartition(4).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", LAKE_QUERIES)
def test_query_covers_all_years(spark, two_years, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{two_years}/events.parquet/*.parquet')")
    assert differences(QUERIES[name](spark, two_years), con, ORACLES[name]) is None
