"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.storage import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the links (columns a, b).

    Minima are pre-aggregated, and a hub meets its links in a join that adaptive execution can split. Each
    round is written to the shared folder. Nodes without links are not returned.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    mark = None
    while True:
        edges = settle(_small_star(_large_star(edges).distinct()).distinct(), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select("v", "v").distinct()))
