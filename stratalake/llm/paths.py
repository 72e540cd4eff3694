"""Nonbranching paths of a graph that lies in tables, compacted by pointer doubling.

``links`` holds (id, next); an id is at most once on each side. In each round every node that does not know its
head yet takes over what its current pointer points to, so a path of length m takes log2(m) joins.
No two open nodes point at the same node, so no key is hot, and only ids travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch


def _only(side: str, through: str) -> list:
    """The least and greatest of a column over rows that go through, or over all rows where none does."""
    inner = F.when(F.col(through), F.col(side))
    return [F.coalesce(F.min(inner), F.min(side)).alias(side), F.coalesce(F.max(inner), F.max(side)).alias("last")]


def nonbranching(follows: DataFrame) -> DataFrame:
    """The links of ``follows`` (id, next, goes_on, came_from) whose first node has no other next and whose second no other
    predecessor.

    A next that ends a text's run (not ``goes_on``) and a predecessor that begins one (not ``came_from``) are tips: they count
    as branches only among themselves.
    """
    ahead = follows.groupBy("id").agg(*_only("next", "goes_on")).where("next = last")
    back = follows.groupBy("next").agg(*_only("id", "came_from")).where("id = last")
    return ahead.select("id", "next").join(back.select("id", "next"), ["id", "next"])


def _double(table: DataFrame, nodes: int, scratch: Scratch, label: str) -> DataFrame:
    """Let pointers jump until all are at a head, or until only cycles are left."""
    step, reach = 0, 1
    while not table.where("NOT done").isEmpty() and reach <= 2 * nodes:
        step, reach = step + 1, reach * 2
        active = table.where("NOT done").alias("a")
        ahead = table.alias("b")
        jumped = active.join(ahead, F.col("a.head") == F.col("b.id")).select(
            F.col("a.id"), F.col("b.head"), (F.col("a.offset") + F.col("b.offset")).alias("offset"),
            F.least("a.least", "b.least").alias("least"), F.col("b.done"))
        table = scratch.write(table.where("done").union(jumped), f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
    return table


def _start(links: DataFrame, ids: DataFrame) -> DataFrame:
    back = links.select(F.col("next").alias("id"), F.col("id").alias("before"), "size")
    return ids.join(back, "id", "left").select(
        "id", F.coalesce("before", "id").alias("head"), F.coalesce("size", F.lit(0)).cast("long").alias("offset"),
        F.least("id", F.coalesce("before", "id")).alias("least"), F.col("before").isNull().alias("done"))


def compact(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(id, path, offset) of every node in ``links`` (id, next, size): its path's first node and how far it lies from it.

    ``size`` is the length of the node ``id``, so that offsets add up. A cycle is cut before its least node.
    """
    ids = links.select("id").union(links.select(F.col("next"))).distinct()
    table = scratch.write(_start(links, ids), f"{label}-0")
    nodes = table.count()
    table = _double(table, nodes, scratch, label)
    rings = table.where("NOT done")
    if not rings.isEmpty():
        ring = scratch.write(rings.select("id", "least"), f"{label}-rings")
        cut = links.join(ring, "id").where("next <> least").select("id", "next", "size")
        opened = _double(scratch.write(_start(cut, ring.select("id")), f"{label}-cut-0"), nodes, scratch, f"{label}-cut")
        table = table.where("done").union(opened)
    return table.select("id", F.col("head").alias("path"), "offset")
