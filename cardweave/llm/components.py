"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.storage import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    # Written down: both sides of the join are plain exchanges, and a hub's links can be split.
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_least")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = stage(down.groupBy("a").agg(F.min("b").alias("_least")), "least")
    moved = down.join(least, "a").where("b > _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.union(least.select("a", "_least")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Each round is written to the shared folder; the table of links never grows by more than
    its nodes. Links of a node to itself and repeated links do no harm. No link, no row.
    """
    edges, before = stage(_small_star(edges), "links"), None
    while True:
        size = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if size == before or not size[0]:
            break
        before, edges = size, stage(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
