"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from waferscope.llm.storage import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest member, other member) of each component of the links a-b: at most one per node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[root[other]], nodes[other]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node reachable.

    Large-star and small-star rounds: each round links the larger neighbours of a node, then its smaller
    ones, to the smallest neighbour. Rounds grow with the logarithm of the longest chain, and a round moves each link
    twice, as a grouped minimum and a join, so that no group is gathered in one task. Nodes without links
    (a link to itself counts as none) and null ends are not returned.
    """
    clean = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    edges = stored(links.where(clean).select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct())
    seen = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
        )
        # A node that has only smaller neighbours keeps its links for the second half.
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("low").alias("v"))
        edges = stored(small.where("u <> v").distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
