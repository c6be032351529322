"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch


def _flat(parents: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Parents replaced by their parents until all are roots; the depth halves each time."""
    turn = 0
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        jumped = parents.join(above, "parent").select("node", F.col("root").alias("parent"), (F.col("root") != F.col("parent")).alias("moved"))
        table = scratch.table(jumped, f"{name}-jump{turn}")
        moved = not table.filter("moved").isEmpty()
        parents, turn = table.select("node", "parent"), turn + 1
        if not moved:
            return parents


def components(links: DataFrame, scratch: Scratch, name: str = "graph") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` long); the root is the smallest node reached.

    Each round hangs a node below its smallest neighbour, flattens the trees and keeps the links
    between different roots; at least half of the nodes that have links go in each round. Only
    per-node minima and joins on nodes are shuffled, and every round is a table of its own.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = scratch.table(links.filter(F.col("a") != F.col("b")).select(low, high).distinct(), f"{name}-links0")
    found, turn = None, 0
    while turn == 0 or not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        smallest = both.groupBy("node").agg(F.min("other").alias("other"))
        hung = smallest.select("node", F.least("node", "other").alias("parent"))
        flat = _flat(scratch.table(hung, f"{name}-hung{turn}"), scratch, f"{name}-{turn}")
        if found is None:
            found = flat.withColumnRenamed("parent", "root")
        else:
            above = flat.select(F.col("node").alias("root"), F.col("parent").alias("up"))
            found = found.join(above, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        ends = left.join(flat.select(F.col("node").alias("a"), F.col("parent").alias("ra")), "a").join(
            flat.select(F.col("node").alias("b"), F.col("parent").alias("rb")), "b"
        )
        turn += 1
        again = ends.filter("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        left = scratch.table(again.distinct(), f"{name}-links{turn}")
    return scratch.table(found, f"{name}-components")
