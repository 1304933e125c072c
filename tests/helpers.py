from __future__ import annotations

from collections import Counter
from pathlib import Path

from tickharbor.functions.parsing import add_partition_columns
from tickharbor.schema import PARTITION_COLS


def ticks(spark, rows):
    """(ticker, price, volume, 'YYYY-MM-DD HH:MM:SS') rows as ticks with partition columns."""
    raw = spark.createDataFrame(rows, "ticker string, price double, volume int, at string")
    return add_partition_columns(raw.selectExpr("ticker", "price", "volume", "try_cast(at AS timestamp) AS ts"))


def append(df, path):
    df.write.mode("append").partitionBy(*PARTITION_COLS).parquet(path)


def bag(df, *columns):
    """The rows as a multiset."""
    chosen = df.select(*(columns or sorted(df.columns)))
    return Counter(tuple(row) for row in chosen.collect())


def data_files(path):
    """Parquet files below a local path, per directory."""
    return Counter(str(f.parent.relative_to(path)) for f in Path(path).rglob("*.parquet"))


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
