"""Removal of lines that many sites share.

A line's spread is the number of distinct sites that carry it. Lines of a single site are known from
the least and greatest site alone; for the others HyperLogLog sketches are built and merged by
aggregation, and only lines whose estimate is near the threshold get an exact distinct count.
All of it is built-in aggregates and joins: a line that a third of all rows carry arrives as one
partial row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stage

#: Lines under ``MIN_CHARS`` characters, less than most words, are left out; a blank line is one of them.
MIN_SITES, MIN_CHARS, LG_REGISTERS = 8, 4, 12
_KEY = ["line_a", "line_b"]


def _trimmed(line: Column) -> Column:
    return F.trim(line)


def _line_keys(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("line_a"), F.hash(line).alias("line_b")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, lg_registers: int = LG_REGISTERS
) -> tuple[DataFrame, DataFrame]:
    """Lines on at least ``min_sites`` sites, and all occurrences of lines of two sites or more.

    First: ``line_a, line_b, home`` (two hashes of the trimmed line; its smallest ``doc_id``). Second:
    ``doc_id, site`` with the same key. Lines of under ``min_chars`` characters are left out. A NULL
    source counts as one site. The estimate decides where it is further from the threshold than three
    standard errors (one site at least); else the count is exact.
    """
    line = F.explode(F.transform(_lines(F.col("text")), _trimmed)).alias("line")
    rows = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("site"), line)
    rows = rows.where(F.char_length("line") >= min_chars).select("doc_id", "site", *_line_keys(F.col("line")))
    spread = (
        rows.groupBy(*_KEY)
        .agg(F.min("site").alias("low"), F.max("site").alias("high"), F.min("doc_id").alias("home"))
        .where("low <> high")
        .select(*_KEY, "home")
    )
    several = stage(spread, "lines")
    seen = stage(rows.join(several, _KEY).select("doc_id", "site", *_KEY, "home"), "line-uses")
    sketched = seen.groupBy(*_KEY, "home").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_registers)).alias("sites")
    )
    margin = max(1.0, 3 * 1.04 / 2 ** (lg_registers / 2) * min_sites)
    judged = stage(sketched.where(F.col("sites") >= min_sites - margin), "line-spread")
    sure = F.col("sites") > min_sites + margin
    exact = (
        seen.join(judged.where(~sure).select(*_KEY), _KEY, "left_semi")
        .groupBy(*_KEY, "home", "site").agg(F.lit(1).alias("one"))
        .groupBy(*_KEY, "home").agg(F.count("one").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return judged.where(sure).select(*_KEY, "home").unionByName(exact.select(*_KEY, "home")), seen


def without_shared_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``docs`` with shared lines taken out of every text but that of the smallest ``doc_id`` with the line.

    Adds ``n_lines`` and ``n_removed``; the kept lines stay as they were, in order. NULL texts stay
    NULL with one (empty) line. Rows without a ``doc_id`` are counted as users of a line but stay whole;
    rows that repeat a ``doc_id`` are treated alike. Other columns of ``docs`` stay, whatever their names, but that
    a column called ``n_lines`` or ``n_removed`` is replaced. No rows give none.
    """
    names = [name for name in docs.columns if name.lower() not in ("n_lines", "n_removed")]
    docs = docs.select(*[F.col(f"`{name}`") for name in names])
    own_doc, own_lines, own_kept, own_text = _free(names, "dropped_doc", "dropped_lines", "kept_lines", "new_text")
    shared, seen = shared_lines(docs.select("doc_id", "source", "text"), min_sites, min_chars, lg_registers)
    dropped = (
        seen.join(shared.select(*_KEY), _KEY, "left_semi")
        .where("doc_id <> home")
        .groupBy(F.col("doc_id").alias(own_doc))
        .agg(F.collect_set(F.struct(*_KEY)).alias(own_lines))
    )
    lines, drops = _lines(F.col("text")), F.col(own_lines)

    def stays(line: Column) -> Column:
        return ~F.array_contains(drops, F.struct(*_line_keys(_trimmed(line))))

    kept = F.when(drops.isNull(), lines).otherwise(F.filter(lines, stays))
    joined = docs.join(dropped, docs.doc_id == F.col(own_doc), "left").withColumn(own_kept, kept)
    text = F.when(F.col(own_lines).isNull(), F.col("text")).otherwise(F.array_join(own_kept, "\n"))
    return joined.withColumns(
        {
            "n_lines": F.size(lines).cast("bigint"),
            "n_removed": (F.size(lines) - F.size(own_kept)).cast("bigint"),
            own_text: text,
        }
    ).select(*[F.col(own_text).alias("text") if n == "text" else F.col(f"`{n}`") for n in names], "n_lines", "n_removed")


def _free(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from a column."""
    used, out = {name.lower() for name in taken}, []
    for name in names:
        while name in used:
            name = f"{name}_"
        out.append(name)
    return out
