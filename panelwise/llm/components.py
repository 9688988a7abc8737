"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Scratch


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    moved = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.filter("u != m").select("u", F.col("m").alias("v")))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)`` that is not a root itself; the root is the smallest node it can reach.

    Each step is a join and an aggregation that adds up in the map tasks, so a node with very many
    neighbours is no trouble. The edges of each round are staged; the rounds end when nothing changes, then every
    component is a star.
    """
    same = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = scratch.stage(edges.filter("u != v").select("u", "v").distinct())
    state = same(now)
    while state[0]:
        half = _large_star(now).distinct()
        after = scratch.stage(_small_star(half).distinct())
        scratch.drop(now)
        now, before, state = after, state, same(after)
        # The stars of the last round come out of the next unchanged (as pairs, larger node first).
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
