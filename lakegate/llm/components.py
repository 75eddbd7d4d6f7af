"""Connected components of a table of links, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.plans.staging import stage


def _roots(parents: DataFrame) -> DataFrame:
    """(node, up) with every ``up`` replaced by the root of its tree; ``up`` < ``node`` always."""
    while True:
        above = parents.select(F.col("node").alias("_via"), F.col("up").alias("_next"))
        jumped = parents.join(above, F.col("up") == F.col("_via"), "left").select(
            "node", F.coalesce("_next", "up").alias("up"), F.col("_next").isNotNull().alias("moved")
        )
        jumped = stage(jumped, "roots")
        parents = jumped.select("node", "up")
        if jumped.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component.

    ``links`` has long columns ``a`` and ``b``; links with a null or to oneself are ignored.
    Each round hooks every node to its smallest neighbour, jumps to the roots, and contracts
    the links to links between roots, so their number falls fast. Everything between rounds
    is a written table; nothing comes to the driver but "any row left?".
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    edges = stage(edges, "links")
    labels = None
    while True:
        hooked = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up"))
        roots = _roots(hooked)
        if labels is None:
            labels = roots.withColumnRenamed("up", "root")
        else:
            to = roots.select(F.col("node").alias("_old"), F.col("up").alias("_new"))
            labels = labels.join(to, F.col("root") == F.col("_old"), "left").select(
                "node", F.coalesce("_new", "root").alias("root")
            )
            labels = stage(labels.union(roots), "labels")
        high = roots.select(F.col("node").alias("hi"), F.col("up").alias("_high"))
        low = roots.select(F.col("node").alias("lo"), F.col("up").alias("_low"))
        ends = edges.join(high, "hi", "left").join(low, "lo", "left")
        ends = ends.select(F.coalesce("_high", "hi").alias("x"), F.coalesce("_low", "lo").alias("y"))
        ends = ends.where("x <> y").select(
            F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")
        )
        edges = stage(ends.distinct(), "links")
        if edges.isEmpty():
            return labels
