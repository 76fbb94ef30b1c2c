"""Connected components by alternating large-star and small-star steps.

A step finds the smallest neighbour of each node with a combining aggregation and joins it back to
the edges. No neighbourhood is collected: a hub's minimum is combined before the shuffle and written, so
that its edges meet it in a plain join of two exchanges, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.common import settle


def _mark(edges: DataFrame):
    """Count and an order-free sum that tell whether a step changed anything."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = settle(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable over ``edges`` (u, v), for nodes with an edge.

    Self-loops and repeated edges are allowed; rows with a null end are not. An empty table gives
    no rows. A root is listed with itself.
    """
    current = settle(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(),
        "components",
    )
    mark = _mark(current)
    while True:
        current = settle(_small_star(_large_star(current)).distinct(), "components")
        last, mark = mark, _mark(current)
        if mark == last:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
