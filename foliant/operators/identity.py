"""Which new records are one entity: those connected by any of their keys, directly or by way of others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Rounds after which every component must have become one vertex; each halves a chain, by chance.
ROUNDS = 120


def connected(records: DataFrame, rid: str, keys: Column) -> DataFrame:
    """rid, root of every record: the least rid among the records that share a key with it, by any number of steps.

    keys is an array of strings, of which NULL ones don't count. Only keys that several records have are walked. The least record
    of a key stands for it, so a record is an edge between the least of its keys' records and each of the others; of what is then left, which
    is as many vertices as there are shared keys, every vertex is merged into the neighbour that comes first in an order
    drawn anew each round. What a round moves shrinks with the graph, so all rounds together move little more than the
    first, however long the chains. Everything is written down, nothing is collected. Records of NULL rid have no row.
    """
    scratch = Scratch(records.sparkSession, "identity")
    pairs = records.where(F.col(rid).isNotNull()).select(F.col(rid).alias("rid"), F.explode(F.array_distinct(keys)).alias("key")).where("key is not null")
    pairs = scratch.write(pairs, "pairs")
    least = pairs.groupBy("key").agg(F.min("rid").alias("least"), F.max("rid").alias("most")).where("least < most").select("key", "least")
    near = pairs.join(least, "key").groupBy("rid").agg(F.min("least").alias("near"), F.collect_set("least").alias("all"))
    near = scratch.write(near, "near")
    scratch.drop("pairs")
    edges = near.where(F.size("all") > 1).select(F.col("near").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct()
    edges, merged = scratch.write(edges, "edges-0"), []
    while not edges.isEmpty():
        if len(merged) == ROUNDS:
            raise ValueError("records did not settle into entities")
        k = len(merged)
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("w"))
        to = both.groupBy("v").agg(F.min(order("w")).alias("m")).select("v", F.least("m", order("v"))["w"].alias("to"))
        merged.append(scratch.write(to, f"to-{k}"))
        at = lambda c: merged[-1].select(F.col("v").alias(c), F.col("to").alias(f"to_{c}"))
        moved = edges.join(at("a"), "a").join(at("b"), "b").where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = scratch.write(moved.distinct(), f"edges-{k + 1}")
        scratch.drop(f"edges-{k}")
    alone = records.where(F.col(rid).isNotNull()).select(F.col(rid).alias("rid")).distinct()
    roots = near.select("rid", F.col("near").alias("root"))
    if merged:
        # From the last round back: where a round's vertices have gone in the end, then the least of those that went to one place.
        gone = merged[-1]
        for k in range(len(merged) - 2, -1, -1):
            later = gone.select(F.col("v").alias("to"), F.col("to").alias("end"))
            gone = scratch.write(merged[k].join(later, "to", "left").select("v", F.coalesce("end", "to").alias("to")), f"gone-{k}")
        first = gone.groupBy("to").agg(F.min("v").alias("first"))
        first = scratch.write(gone.join(first, "to").select(F.col("v").alias("root"), "first"), "first")
        scratch.drop(f"edges-{len(merged)}", *[f"{name}-{k}" for k in range(len(merged)) for name in ("to", "gone")])
        roots = roots.join(first, "root", "left").select("rid", F.coalesce("first", "root").alias("root"))
    return alone.join(roots, "rid", "left").select(F.col("rid").alias(rid), F.coalesce("root", "rid").alias("root"))


def named_keys(**columns: Column) -> Column:
    """Keys that are equal only if they are of one name: an array of 'name:value', NULL where a value is."""
    return F.array(*[F.concat(F.lit(f"{n}:"), c.cast("string")) for n, c in columns.items()])
