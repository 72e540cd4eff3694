"""Connected components of an edge table, by alternating large and small stars.

Each round every node hands its neighbours the least node it knows. A node with very many neighbours is
only ever one side of a join, never a collected group, and only ids travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``id`` and ``component`` (the least id reachable) of every node of ``links`` (columns a, b)."""
    edges = scratch.write(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{label}-0")
    state, step = _state(edges), 0
    while state[0]:
        step += 1
        edges = scratch.write(_small_star(_large_star(edges)), f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component")))
