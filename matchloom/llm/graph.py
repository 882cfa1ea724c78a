"""Connected components of a large graph, without gathering any part of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


#: Parts of a node's neighbours.
SALTS = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """edges with the least neighbour m of u."""
    e = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = e.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return e.join(parts.select("u", "salt").join(least, "u"), ["u", "salt"])


def connected_components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in `edges` (u, v): root is the least node of its component.

    Rounds of large-star and small-star rewriting; a round shuffles the edges a few times, and their number never grows.
    A node with many neighbours is never one key: its least neighbour is found and brought back by SALTS parts of it.
    Each round is written to the shared folder, so a lost executor costs one round.
    """
    e = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v").distinct()
        large = materialize(large, name)
        small = _with_least(large)
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(large.groupBy("u").agg(F.min("v").alias("v")))
        e = materialize(small.filter("u != v").distinct(), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the least node of their component, for edges held in memory."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new
