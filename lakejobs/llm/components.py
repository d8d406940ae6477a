"""Connected components of a graph given as edges, by DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours with the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    linked = both.filter("b > a").join(lowest, "a")
    return linked.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours with the smallest of them; `edges` run from larger to smaller."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    linked = edges.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(lowest.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Rows (node, component): each node of the edges (a, b) and the smallest node it is connected with.

    Large-star and small-star steps alternate until all edges point at their component's smallest node.
    Each round is written to the shared folder, which cuts the lineage. The smallest edge of a
    node with very many neighbours is found by minima that start before the shuffle, but all its edges meet it in one
    task of a join.
    Loops and null ends are ignored. No edges give no rows.
    """
    clean = edges.select("a", "b").filter("a <> b")
    ordered = clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(ordered.distinct(), purpose)
    while True:
        ends = current.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            current.select("b", F.lit(0), F.lit(1))
        )
        flat = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if flat.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty():
            break
        current = stage(_small_star(_large_star(current)), purpose)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select("b", "b").distinct())
