"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import materialized


def are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is one itself, not both."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"),
                                         F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of links (a, b).

    Each round ties every node's larger neighbours to its smallest one, then every node and its
    smaller neighbours likewise, until the links are stars around the smallest nodes. Neighbour
    lists are never gathered: a node with very many neighbours is an aggregate and a join, which
    adaptive execution can split.
    """
    # Larger node first.
    edges = materialized(links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct())
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        tied = both.join(lowest, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = tied.groupBy("a").agg(F.min("b").alias("m"))
        joined = tied.join(lowest, "a")
        edges = materialized(
            joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
