"""Named models: a query kept as a view or a table, and the two starter models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Keep ``df`` under ``name``, as a view (default) or a table, and return the reference to it."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    return df.sparkSession.table(name)


def first_model(spark: SparkSession) -> DataFrame:
    """Literal rows: the ids 1 and NULL."""
    return spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")


def second_model(spark: SparkSession, ref: str = "first_model") -> DataFrame:
    """All columns of the referenced model where ``id`` is 1."""
    return spark.table(ref).where(F.col("id") == 1)
