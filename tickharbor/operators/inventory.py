"""Summaries, differences and compaction checks over file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNGROUPED = "ungrouped"


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """One row: number of files and total bytes."""
    return inventory.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total_bytes"),
    )


def _or_ungrouped(label: Column) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.lit(UNGROUPED))


def _below(prefix: str | None) -> Column:
    key = F.col("key")
    if not prefix:
        return key
    return F.when(key.startswith(prefix), F.substr(key, F.lit(len(prefix) + 1))).otherwise(key)


def inventory_by_group(
    inventory: DataFrame, prefix: str | None = None, accept_date: bool = False
) -> DataFrame:
    """Files and bytes per year label, sorted by label.

    The label is the four-digit ``year=`` in the key (below ``prefix``), else ``ungrouped``.
    With ``accept_date``, labels are whole ``year=`` segments, or ``date=`` segments where a
    key has no year.
    """
    key = _below(prefix)
    if accept_date:
        label = F.coalesce(
            F.nullif(F.regexp_extract(key, r"(?:^|/)(year=[^/]+)", 1), F.lit("")),
            F.regexp_extract(key, r"(?:^|/)(date=[^/]+)", 1),
        )
    else:
        label = F.regexp_extract(key, r"(year=\d{4})", 1)
    return (
        inventory.groupBy(_or_ungrouped(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").cast("bigint").alias("n_bytes"))
        .orderBy("label")
    )


def day_label(key: str = "key") -> Column:
    """The year, month and day segments of a key joined by ``/``; hours are ignored."""
    segments = F.regexp_extract_all(key, F.lit(r"(?:^|/)((?:year|month|day)=[^/]*)"), F.lit(1))
    return _or_ungrouped(F.array_join(segments, "/"))


def inventory_by_partition(inventory: DataFrame) -> DataFrame:
    """Number of files per day label."""
    return inventory.groupBy(day_label().alias("label")).agg(F.count(F.lit(1)).alias("n_files"))


def largest_files(inventory: DataFrame, n: int = 5) -> DataFrame:
    return inventory.orderBy(F.desc("size"), "key").limit(n)


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys that were added, removed or changed size between two inventories."""
    joined = before.select("key", F.col("size").alias("size_before")).join(
        after.select("key", F.col("size").alias("size_after")), "key", "full_outer"
    )
    change = (
        F.when(F.col("size_before").isNull(), "added")
        .when(F.col("size_after").isNull(), "removed")
        .when(F.col("size_before") != F.col("size_after"), "size_changed")
    )
    return (
        joined.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select("key", "change", "size_before", "size_after")
    )


def compaction_reduction(
    before: DataFrame, after: DataFrame, per_partition: bool = False
) -> DataFrame:
    """File counts before and after, and the reduction in percent (0 if there were none before).

    Overall (one row, label ``all``) or per day label: days that only *after* has are ignored,
    days that it lacks count 0.
    """
    if per_partition:
        counted = (
            inventory_by_partition(before)
            .withColumnRenamed("n_files", "files_before")
            .join(inventory_by_partition(after).withColumnRenamed("n_files", "n_after"), "label", "left")
            .withColumn("files_after", F.coalesce("n_after", F.lit(0)))
        )
    else:
        tagged = before.select(F.lit(1).alias("b")).unionByName(
            after.select(F.lit(0).alias("b"))
        )
        counted = tagged.agg(
            F.coalesce(F.sum("b"), F.lit(0)).alias("files_before"),
            F.coalesce(F.sum(1 - F.col("b")), F.lit(0)).alias("files_after"),
        ).withColumn("label", F.lit("all"))
    fewer = (F.col("files_before") - F.col("files_after")).cast("double")
    return counted.select(
        "label",
        F.col("files_before").cast("bigint").alias("files_before"),
        F.col("files_after").cast("bigint").alias("files_after"),
        F.when(F.col("files_before") > 0, fewer / F.col("files_before") * 100)
        .otherwise(F.lit(0.0))
        .alias("reduction_pct"),
    )


def assert_compaction(
    before: DataFrame,
    after: DataFrame,
    min_pct: float = 0.0,
    per_partition: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The rows of :func:`compaction_reduction` that miss the target; none means it passed.

    The target is a reduction of at least ``min_pct``, which no files before always meets;
    ``strict`` wants fewer files than before as well, in every case.
    """
    missed = (F.col("files_before") > 0) & (F.col("reduction_pct") < min_pct)
    if strict:
        missed = missed | (F.col("files_after") >= F.col("files_before"))
    return compaction_reduction(before, after, per_partition).where(missed)


class CompactionCheckFailed(AssertionError):
    """A compaction did not reach its target."""


def require_compaction(failures: DataFrame, shown: int = 20) -> None:
    """Raise if ``failures`` has rows; the message counts them and names the first few."""
    rows = failures.limit(shown).collect()
    if rows:
        named = "; ".join(str(row.asDict()) for row in rows)
        raise CompactionCheckFailed(f"{failures.count()} failures: {named}")
