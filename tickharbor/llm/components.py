"""Connected components by contraction, with every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage


def _rooted(parents: DataFrame) -> DataFrame:
    """``node, parent`` with each parent replaced by the root of its tree: the way halves each time."""
    while True:
        up = parents.select(F.col("node").alias("above"), F.col("parent").alias("higher"))
        step = parents.join(up, parents.parent == up.above, "left").select(
            "node", F.coalesce("higher", "parent").alias("parent"), (F.col("higher") < F.col("parent")).alias("moved")
        )
        parents = stage(step, "roots")
        if parents.where("moved").isEmpty():
            return parents.select("node", "parent")
        parents = parents.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``edges`` (``a, b``): the smallest node that can be reached.

    Each node hooks onto its smallest neighbour if that is smaller, trees shrink to their roots, and
    edges between roots go on to the next round. Nothing but row counts reaches the driver.
    """
    left = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _rooted(stage(hooks.select("node", F.least("node", "least").alias("parent")), "hooks"))
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("label"))
        else:
            up = roots.select(F.col("node").alias("label"), F.col("parent").alias("higher"))
            labels = stage(
                labels.join(up, "label", "left").select("node", F.coalesce("higher", "label").alias("label")), "labels"
            )
        a = roots.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        b = roots.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        joined = left.join(a, "a").join(b, "b").where("root_a <> root_b")
        left = stage(joined.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).where("false")
    return labels
