"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregations and joins on the node; nothing but the number of
changed edges reaches the driver. Neighbourhood minima are pre-aggregated, so a
hub with very many neighbours is one row per task and node, never one list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges ``u > v`` (small) or on both directions (large)."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(lowest, both["u"] == lowest["w"])
    if large:  # every larger neighbour now points at the minimum
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:      # the node and all its smaller neighbours point at the minimum
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``node, component`` for every node of an edge: its component's smallest node."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    current = cut(pairs, f"{name}-edges")
    before = None
    while True:
        current = cut(_star(_star(current, large=True), large=False), f"{name}-star")
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(
        roots.select(F.col("component").alias("node"), "component").distinct())
