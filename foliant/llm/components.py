"""Connected components of an edge table, by the least label and pointer jumping; every round is written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components: of a node with several neighbours only the least stays, which the others join instead.

    Where many nodes share their neighbours, as all members of a bucket do, most of those joins are the same edge.
    """
    by = edges.where("a <> b").groupBy("a").agg(F.min("b").alias("b"), F.collect_set("b").alias("all"))
    others = by.select(F.col("b").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct()
    return by.select("a", "b").unionByName(others)


def components(edges: DataFrame, scratch: Scratch, name: str, most: int = 60) -> DataFrame:
    """node, root of every node of edges (a, b): root is the least node of its component.

    A round takes the least label among neighbours and then the label of that label, so chains shorten by
    more than half. Only (node, label) rows move; nothing is collected, and only the last round's table stays.
    Without edges there are no rows; repeated edges and edges from a node to itself change nothing.
    """
    few = contracted(edges)
    both = scratch.write(few.unionByName(few.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels, last = scratch.write(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), f"{name}-0"), f"{name}-0"
    for k in range(1, most):
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(seen, labels["node"] == seen["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        # A label that is itself least within reach has no lower one; the join leaves such rows as they are.
        new = scratch.write(lower.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), f"{name}-{k}")
        settled = new.where("old <> root").isEmpty()
        scratch.drop(last)
        labels, last = new.select("node", "root"), f"{name}-{k}"
        if settled:
            scratch.drop(f"{name}-edges")
            return labels
    raise ValueError("components did not settle")
