"""Distributed union-find: connected components by hooking and pointer jumping on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash


def components(edges: DataFrame, stash: Stash) -> DataFrame:
    """(node, label) of all nodes in edges(src, dst): label is the least node of the component.

    Each round hooks every node to its least neighbour, jumps pointers until each tree is a star, and contracts the
    edges to the trees' roots. Edges at least halve with their roots in each round. Minima are combined on the map
    side, so a hub of any degree costs its tasks one row each. Every step is a table in the shared folder. Self-loops
    and repeated edges are ignored, an empty input gives no rows.
    """
    edges = stash(_undirected(edges))
    trees: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        up = stash(ends.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least")).select("node", F.least("node", "least").alias("up")))
        while True:
            next_up = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = stash(up.join(next_up, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            stash.drop(up)
            up = jumped
            if up.filter("moved").isEmpty():
                break
            up = up.select("node", "up")
            up.stash_path = jumped.stash_path
        root = up.select("node", "up")
        trees.append(root)
        joined = edges.join(root.toDF("src", "a"), "src").join(root.toDF("dst", "b"), "dst")
        contracted = stash(_undirected(joined.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
        stash.drop(edges)
        edges = contracted
    if not trees:
        return edges.select(F.col("src").alias("node"), F.col("dst").alias("label"))
    labels = trees[0].toDF("node", "label")
    for tree in trees[1:]:
        labels = labels.join(tree.toDF("label", "up"), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return stash(labels)


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.filter("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
