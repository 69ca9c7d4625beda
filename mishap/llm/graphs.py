"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import held


def _roots(pointers: DataFrame, rows: int) -> DataFrame:
    """Follow pointers (a, p), each to a smaller node, to their ends; chains halve by every jump."""
    while True:
        further = pointers.select(F.col("a").alias("p"), F.col("p").alias("next"))
        jumped = pointers.join(further, "p", "left").select(
            "a", F.coalesce("next", "p").alias("p"), F.col("next").isNotNull().alias("moved")
        )
        jumped = held(jumped, rows)
        pointers = jumped.select("a", "p")
        if jumped.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), with the least node as component.

    In each round every node points to its least smaller neighbour, chains of pointers are followed
    to their roots, and the edges shrink to those between different roots, so that a round leaves at
    most half of the nodes that had edges. A hub with many edges is only a join key (which adaptive
    execution splits) and a minimum that tasks combine before the shuffle; no round holds more rows
    than there are edges. Rounds are checkpointed, so lost executors cost one round; the edges are
    counted first, as no checkpoint needs more files than they fill. Edges should be a written table.
    """
    rows = edges.count()
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = held(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), rows)
    rounds = []
    while not edges.isEmpty():
        pointers = _roots(held(edges.groupBy("a").agg(F.min("b").alias("p")), rows), rows)
        rounds.append(pointers)
        left = edges.join(pointers, "a").select(F.col("p").alias("x"), "b")
        right = pointers.select(F.col("a").alias("b"), F.col("p").alias("y"))
        both = left.join(right, "b", "left").select(
            F.col("x").alias("a"), F.coalesce("y", "b").alias("b")
        )
        edges = held(both.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), rows)
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds.pop()
    while rounds:
        earlier = rounds.pop()
        later = found.select(F.col("a").alias("p"), F.col("p").alias("root"))
        merged = earlier.join(later, "p", "left").select("a", F.coalesce("root", "p").alias("p"))
        found = held(merged.unionByName(found), rows)
    roots = found.select(F.col("p").alias("a"), "p").distinct()
    return found.unionByName(roots).select(F.col("a").alias("node"), F.col("p").alias("component"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 of one task, the least node that edges (a, b) connect each with."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while not np.array_equal(root, root[root]):
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
