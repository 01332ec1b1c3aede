"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.storage import dropped, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return pairs.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (u, v) reaches.

    Nodes are longs. Self-links and repeated links are allowed, links with a null end are ignored; no links give no rows.
    A step sends each link once and never gathers the neighbours of a node; only a count comes to the driver.
    A node with many links is a hot join key, which adaptive execution splits.
    """
    nodes = edges.where("u is not null and v is not null")
    current = stored(nodes.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        # Large star: each node hands its larger neighbours the least node it knows.
        pairs = _both_ways(current)
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = _star(pairs.where("v > u"), least).distinct()
        # Small star: each node hands its smaller neighbours, and itself, the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = _star(large, least).union(least.select("u", F.col("least").alias("v")))
        after = stored(small.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        # Done when every link leads to a root: no node has two targets, no target has one itself.
        open_ = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        done = open_ and after.join(after.select(F.col("u").alias("root")), F.col("v") == F.col("root"), "left_semi").isEmpty()
        dropped(current)
        current = after
        if done:
            break
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.union(roots.distinct())
