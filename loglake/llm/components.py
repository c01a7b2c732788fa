"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours point to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: of each node of the edges ``a, b`` the smallest node it can reach.

    Smallest values are found by partial aggregation and joined back, so a node with very many
    neighbours is no single task's work. Every round is written to the shared folder.
    """
    edges = stored(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    state = None
    while True:
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        state = tuple(row)
        edges = stored(_small(_large(edges).distinct()).distinct(), "edges")
