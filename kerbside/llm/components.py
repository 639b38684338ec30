"""Connected components: within a task over numpy arrays, and over all tasks by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import checkpointed


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect the same nodes: each node but the smallest of its component, and that smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        open_ = low != high
        if not open_.any():
            break
        x, y = x[open_], y[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots; the root is the smallest node.

    Large and small stars in turn: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones, until each node points to its root. The smallest
    neighbour is an aggregate and is joined back, so a node with many links is combined in
    each task first and AQE can split it in the join. The number of rows never grows.
    """
    ordered = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = checkpointed(ordered(links.select("a", "b")))
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = checkpointed(ordered(small))
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
