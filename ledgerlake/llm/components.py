"""Connected components as joins: large-star and small-star steps over an edge table.

Each step links nodes of a neighbourhood to its smallest node; after a logarithmic
number of steps every component is a star around its smallest node.  The edges are
written to the shared folder in every round (cutting the lineage); only whether they form
stars yet reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (both.join(low, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = e.groupBy("a").agg(F.min("b").alias("low"))
    x = e.join(low, "a")
    return (x.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(x.select("a", F.col("low").alias("b")))
            .filter("a != b").distinct())


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    if not edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return False
    parents = edges.select(F.col("b").alias("a")).distinct()
    return edges.join(parents, "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of ``edges`` (a, b)."""
    now = materialize(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while not _is_star(now):
        now = materialize(_small_star(_large_star(now)), "components")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
