import pytest

from tickharbor import operators as ops

from .helpers import bag, ticks


def test_starter_models_and_their_contract(spark):
    first = ops.materialize(ops.first_model(spark), "first_model")
    assert first.dtypes == [("id", "int")] and first.count() == 2
    second = ops.materialize(ops.second_model(spark), "second_model")
    assert [r.id for r in second.collect()] == [1]
    assert ops.not_null_violations(first, "id").count() == 1
    assert ops.unique_violations(first, "id").count() == 0
    assert ops.not_null_violations(second, "id").count() == 0
    assert ops.unique_violations(second, "id").count() == 0


def test_materialize_as_table(spark, base):
    table = ops.materialize(ops.first_model(spark), "kept_model", "table", f"{base}/kept")
    assert table.count() == 2 and spark.read.parquet(f"{base}/kept").count() == 2
    with pytest.raises(ValueError):
        ops.materialize(table, "x", "ephemeral")


def test_unique_counts_values_not_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert bag(ops.unique_violations(df, "id")) == {(1, 2): 1}


@pytest.mark.parametrize(
    "rows, columns, failing",
    [
        ([("A", 1.0, 1, "2025-01-01 00:00:00")], None, set()),
        ([(None, 1.0, 1, "2025-01-01 00:00:00")], None, {"has_tickers"}),
        ([], None, {"has_rows", "has_tickers"}),
        ([("A", 1.0, 1, None)], ["ticker", "price"], {"event_time_column"}),
        ([("A", 1.0, 1, None)], ["ts", "price"], {"ticker_column", "has_tickers"}),
    ],
)
def test_check_ticks(spark, rows, columns, failing):
    df = ticks(spark, rows)
    report = ops.check_ticks(df.select(columns) if columns else df).collect()
    assert len(report) == 4
    assert {r["check"] for r in report if not r.passed} == failing
