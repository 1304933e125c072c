"""Changes of a keyed result, batch by batch, merged as they grow in number.

A batch writes the rows that changed as a run of level 0. Every ``FAN`` runs of a level that follow each other are merged
by key into one run of the next level, in the batch that completes them. The batches so far are then covered by
fewer than ``FAN`` runs of each level: a reader of ``n`` batches opens at most ``(FAN - 1) * log(n)`` runs, and a row is
rewritten once per level. Which runs those are follows from the number of the last batch alone.

Runs are never changed once a batch that uses them is published, by one small file created exclusively; a batch
that is run again writes its runs anew, or finds that it was published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import create_small, names_in, read_small, remove_folder

FAN = 16
_KEPT = 64


def covering(last: int, fan: int = FAN) -> list[tuple[int, int]]:
    """The runs, as (level, number), that together hold the batches 0 to ``last`` once each, oldest first."""
    out, start = [], 0
    while start <= last:
        level, size = 0, 1
        while start % (size * fan) == 0 and start + size * fan <= last + 1:
            level, size = level + 1, size * fan
        out.append((level, start // size))
        start += size
    return out


def _run(path: str, level: int, number: int) -> str:
    return f"{path}/level-{level}/run-{number}"


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [name for name in rows.columns if name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("newest"))
    return newest.select(*keys, "newest.*")


def write_changes(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str], fan: int = FAN) -> None:
    """Keep the changed rows of a batch, with the merges that it completes. Batches come in order, from 0."""
    spark = rows.sparkSession
    record = f"{path}/_batches/{batch_id:012d}"
    if read_small(spark, record) is not None:
        return
    changed = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    changed.hint("rebalance").write.mode("overwrite").parquet(_run(path, 0, batch_id))
    level, size = 1, fan
    while (batch_id + 1) % size == 0:
        number = batch_id // size
        parts = [_run(path, level - 1, number * fan + i) for i in range(fan)]
        merged = _newest(spark.read.schema(changed.schema).parquet(*parts), keys)
        merged.write.mode("overwrite").parquet(_run(path, level, number))
        level, size = level + 1, size * fan
    create_small(spark, record, "")
    for old in names_in(spark, f"{path}/_batches")[:-_KEPT]:
        remove_folder(spark, f"{path}/_batches/{old}")
    # Readers that began before the last merge have had half of the batches up to the next one.
    if batch_id % fan == fan // 2:
        _remove_merged(spark, path, batch_id, fan)


def _remove_merged(spark: SparkSession, path: str, last: int, fan: int) -> None:
    used = {_run(path, *run) for run in covering(last, fan)}
    for level in names_in(spark, path):
        if level.startswith("level-"):
            for run in names_in(spark, f"{path}/{level}"):
                if f"{path}/{level}/{run}" not in used:
                    remove_folder(spark, f"{path}/{level}/{run}")


def read_changes(spark: SparkSession, path: str, keys: Sequence[str], fan: int = FAN) -> DataFrame:
    """The newest row of every key, as of the last published batch."""
    published = [name for name in names_in(spark, f"{path}/_batches") if read_small(spark, f"{path}/_batches/{name}") is not None]
    if not published:
        raise FileNotFoundError(f"no published batch below {path}")
    runs = [_run(path, *run) for run in covering(int(published[-1]), fan)]
    return _newest(spark.read.parquet(*runs), keys).drop("batch_id")
