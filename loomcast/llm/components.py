"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) of every node of ``links`` (a, b).

    Each round lets every node point to its smallest neighbour or itself, follows two
    such steps, and goes on with the links between different targets. Only local minima
    survive a round, so chains at least halve and stars vanish. All rounds are written
    tables; nothing is gathered.
    """
    edges = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = keep(edges.distinct(), "links")
    roots: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = keep(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "steps"
        )
        on = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        step = keep(step.join(on, "to").select("node", F.col("further").alias("to")), "steps")
        if roots is None:
            roots = step.select("node", F.col("to").alias("root"))
        else:
            moved = step.select(F.col("node").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = keep(roots, "roots")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = edges.join(left, "a").join(right, "b").filter("x <> y")
        edges = keep(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
