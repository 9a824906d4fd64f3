"""Connected components of links, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import durable

LINKS_PER_PART, LEAST_PARTS = 100_000, 8


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``links`` (a, b) with a root other than itself.

    Every round replaces each node's links by links to its smallest neighbour, first for
    larger and then for smaller neighbours.  Minima are combined on the map side; the join
    that hands them back may be split where a node has very many links.  No links are
    brought to the driver, only the number of those that keep the result from being stars.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = durable(edges.distinct())
    # Links are few beside the documents: so many partitions that each holds enough of them.
    parts = max(LEAST_PARTS, -(-edges.count() // LINKS_PER_PART))
    edges = edges.coalesce(parts)
    while not stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.coalesce(parts))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = moved.coalesce(parts).union(least.select("a", F.col("m").alias("b")).coalesce(parts)).distinct()
        edges = durable(edges.coalesce(parts))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def stars(edges: DataFrame) -> bool:
    """Whether every node has one root, which has none."""
    ends = edges.select("a", F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("a").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.where((F.col("below") > 1) | (F.col("below") > 0) & (F.col("above") > 0)).isEmpty()
