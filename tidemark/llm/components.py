"""Connected components by contraction, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); nodes of a component share a label.

    Each round hooks a node to its least neighbour and that one's least neighbour, then replaces the
    edges by edges between what nodes were hooked to. Edges inside a component vanish; stars go
    in one round and chains shrink at least by half, so rounds grow with the logarithm of a chain. All
    steps are joins and minimums; a component is never gathered.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "cc-near")
        again = near.select(F.col("a").alias("to"), F.col("to").alias("to2"))
        hooks = stored(near.join(again, "to", "left").select("a", F.coalesce("to2", "to").alias("to")), "cc-hooks")
        if labels is None:
            labels = hooks.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            moved = hooks.select(F.col("a").alias("label"), "to")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        labels = stored(labels, "cc-labels")
        left = hooks.select("a", F.col("to").alias("ta"))
        right = hooks.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        met = edges.join(left, "a").join(right, "b").where("ta <> tb")
        edges = stored(met.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
