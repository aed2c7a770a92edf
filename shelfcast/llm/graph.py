"""Connected components of a link table by joins, with the lineage cut in every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    Large-star and small-star steps alternate until only stars are left, in a number of rounds that
    grows with the logarithm of a chain's length. Each step is an aggregation (partial before the shuffle) and
    a join, so a node with very many links needs no task of its own; links with a null end or to itself
    do nothing.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.filter(F.col("u") > F.col("v")).distinct()
    table = materialise(edges, "links")
    while not _stars(table.df):
        table = materialise(_small_star(_large_star(table.df)), "links")
    found = table.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = table.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionAll(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    to_least = edges.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
