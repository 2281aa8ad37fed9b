"""Connected components of an edge table, without collecting it anywhere.

Alternates two star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): every node's neighbours are re-attached to the
smallest one it knows, until nothing changes; what is left are stars around
each component's smallest node.  The smallest neighbour is a partial
aggregate, so a hub's neighbours are never gathered; the join that hands it
back is one that adaptive execution can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.store import saved


def smallest(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node that is not its component's smallest, from
    an edge table (left, right) of longs."""
    stars = edges.where("left <> right").select(F.greatest("left", "right").alias("node"), F.least("left", "right").alias("root")).distinct()
    stars = saved(stars)
    state = None
    for _ in range(rounds):
        # every neighbour larger than the node goes to the node's smallest
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
        large = both.where("root > node").join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        rest = stars.join(low, "node").select("node", F.col("low").alias("root"))
        large = large.unionByName(rest).distinct()
        # every neighbour smaller than the node, and the node, go to the smallest
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node").where("root <> low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        stars = saved(small.unionByName(low.select("node", F.col("low").alias("root"))).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return stars
        state = tuple(now)
    raise RuntimeError("components did not settle")


def local(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same within arrays: (nodes, smallest node of their component)."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = place[:len(left)], place[len(left):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if np.array_equal(before, label):
            return nodes, nodes[label]
