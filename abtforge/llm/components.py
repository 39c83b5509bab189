"""Connected components: inside a task over arrays, and across the cluster over edge tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.llm.store import written


def component_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for edges a[i] - b[i] between nodes 0 .. n - 1."""
    label = np.arange(n)
    while True:
        one, other = label[a], label[b]
        low, high = np.minimum(one, other), np.maximum(one, other)
        if np.array_equal(low, high):
            return label
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for all nodes but the smallest ones themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = component_labels(at[:len(a)], at[len(a):], len(nodes))
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v) with the smallest node it can reach.

    Alternates two contractions until nothing changes: neighbours above a node move to the
    smallest neighbour, then each node and its lower neighbours move to the smallest of them.
    Minima are map-side sums per node and the joins can be split by AQE, so a node with very many
    neighbours never needs them in one task.  Every round is a written table.
    """
    one_way = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(one_way, "components")
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u")
        now = written(down.select("u", F.col("m").alias("v")).unionByName(down.select(F.col("v").alias("u"), F.col("m").alias("v")))
                      .where("u <> v").distinct(), "components")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
