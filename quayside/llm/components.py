"""Connected components of a link table, by alternating large and small stars.

Every round replaces each node's links by links to the smallest node it knows.
Minima are aggregated with partial sums and joined back, so a node with very
many links is never gathered in one task; rounds are staged, and their number
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Stager


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links of each node ``u`` moved to the smallest node among its neighbours and itself."""
    both = edges if not larger else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low.hint("merge"), "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(stage: Stager, links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node it can reach."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "edges")
    seen = None
    while True:
        # u > v holds for every edge, so the second star gathers only smaller neighbours.
        edges = stage(_star(edges, True), "large-star")
        edges = stage(_star(edges, False), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return stage(edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
                 .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "labels")
