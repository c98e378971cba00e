"""Mutations of keyed tables as pure functions of the table and the incoming rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def insert_ignore(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """M1: rows whose key exists, or came earlier by order, are not inserted. NULL is a key value."""
    first = Window.partitionBy(*keys).orderBy(*(order or keys))
    once = new.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    old = existing.select(*keys).distinct()
    return existing.unionByName(once.join(old, _same(once, old, keys), "left_anti"))


def skip_on_conflict(df: DataFrame, key: str, new: Column, pk: str, within: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """M2: key becomes new unless another row (of the same values of within) holds that value: one that had it before, else the least pk.

    Losers keep their old value and are marked in `skipped`.
    """
    rows = df.withColumn("__new", new).withColumn("__stays", F.col("__new").eqNullSafe(F.col(key)))
    # Only values that some row would take on can clash; rows that stay as they are, which are most, need no order among them.
    by = ["__new", *within]
    key_, held_ = [f"__k{i}" for i in range(len(by))], [f"__h{i}" for i in range(len(by))]
    first = rows.where(~F.col("__stays") & F.col("__new").isNotNull()).groupBy(*by).agg(F.min(pk).alias("__first")).toDF(*key_, "__first")
    held = rows.where(F.col("__stays") & F.col("__new").isNotNull()).select(*by).distinct().toDF(*held_).withColumn("__held", F.lit(True))
    on = lambda a, b: reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)])
    claims = first.join(held, on(key_, held_), "left").drop(*held_)
    joined = rows.join(claims, on(by, key_), "left").drop(*key_)
    lost = ~F.col("__stays") & F.col("__new").isNotNull() & (F.coalesce("__held", F.lit(False)) | (F.col("__first") != F.col(pk)))
    return joined.withColumn("skipped", F.coalesce(lost, F.lit(False))).withColumn(key, F.when(F.col("skipped"), F.col(key)).otherwise(F.col("__new"))).drop("__new", "__stays", "__first", "__held")


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """M3 to M8: one row a key of either side, each column by its policy.

    fill: the stored value unless NULL or blank; overwrite: the incoming one unless NULL; max: the greater;
    keep: the stored value of stored rows, the incoming of new ones.
    """
    a, b = existing.alias("a"), incoming.alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    marked = a.withColumn("__old", F.lit(True)).alias("a").join(b.withColumn("__in", F.lit(True)).alias("b"), on, "full")

    def column(c, rule):
        old, new = F.col(f"a.{c}"), F.col(f"b.{c}")
        if rule == "fill":
            blank = old.isNull() | (F.trim(old.cast("string")) == "")
            return F.when(blank, F.coalesce(new, old)).otherwise(old)
        if rule == "overwrite":
            return F.coalesce(new, old)
        if rule == "max":
            return F.when(F.col("a.__old"), F.greatest(old, new)).otherwise(new)
        return F.when(F.col("a.__old"), old).otherwise(new)

    return marked.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], *[column(c, r).alias(c) for c, r in policy.items()])


def merge_scores(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """M4: the greater score of stored and incoming, NULL as 0 where both exist; new rows keep a NULL score."""
    a, b = existing.alias("a"), incoming.alias("b")
    both = F.col("a.venue_id").isNotNull() & F.col("b.venue_id").isNotNull()
    top = F.greatest(F.coalesce("a.score", F.lit(0.0)), F.coalesce("b.score", F.lit(0.0)))
    joined = a.join(b, (F.col("a.venue_id") == F.col("b.venue_id")) & (F.col("a.subject_id") == F.col("b.subject_id")), "full")
    score = F.when(both, top).otherwise(F.coalesce("a.score", "b.score"))
    return joined.select(F.coalesce("a.venue_id", "b.venue_id").alias("venue_id"), F.coalesce("a.subject_id", "b.subject_id").alias("subject_id"), score.alias("score"), F.coalesce("b.source", "a.source").alias("source"))


#: How far a version of a work has come; case doesn't matter.
VERSION_RANK = {"submittedversion": 1, "acceptedversion": 2, "publishedversion": 3}


def upgraded_version(current: Column, incoming: Column) -> Column:
    """M8: the incoming version where it ranks at least as high."""

    def rank(c):
        out = F.lit(0)
        for name, n in VERSION_RANK.items():
            out = F.when(F.lower(F.trim(c)) == name, n).otherwise(out)
        return out

    missing = current.isNull() | (current == "")
    return F.when((incoming != "") & (missing | (rank(incoming) >= rank(current))), incoming).otherwise(current)


def new_ids(existing: DataFrame, pk: str, rows: DataFrame, key: str) -> DataFrame:
    """Rows with pk after the greatest existing one: dense over the distinct keys in their order. NULL keys get none.

    Keys are dealt by range and sorted there; their places are written down, so that they can't differ between two
    uses. A place and the running total of the partitions before it, one row each, make the number: no task sorts all keys.
    """
    scratch = Scratch(rows.sparkSession, "ids")
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).sortWithinPartitions(key)
    placed = scratch.write(keys.withColumn("__at", F.monotonically_increasing_id()), "placed")
    placed = placed.select(key, F.shiftright("__at", 33).alias("__part"), (F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("__n"))
    totals = placed.groupBy("__part").agg(F.max("__n").alias("__total"))
    before = F.coalesce(F.sum("__total").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = existing.agg(F.coalesce(F.max(pk), F.lit(0)).alias("m"))
    numbered = placed.join(totals.select("__part", before.alias("__before")), "__part").withColumn(pk, base.scalar() + F.col("__before") + F.col("__n"))
    return rows.join(numbered.select(key, pk), key)
