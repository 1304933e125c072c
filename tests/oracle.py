"""Compare a registered query with its SQL in DuckDB: columns, types, rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

# DuckDB type -> Spark type of a comparable column.
TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return None if value is None or (isinstance(value, float) and pd.isna(value)) else value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = con.sql(sql)
    expected_types = {
        name: TYPES.get(str(dtype), str(dtype)) for name, dtype in zip(result.columns, result.types)
    }
    actual_types = dict(spark_df.dtypes)
    if actual_types != expected_types:
        return f"schema: {actual_types} is not {expected_types}"
    expected = _rows(result.columns, result.fetchall())
    actual = _rows(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        return f"rows: {len(actual)} is not {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}" if wrong else None
