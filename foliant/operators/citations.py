"""The citation graph: repair, resolution and review of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve(references: DataFrame, publications: DataFrame, as_of: Column) -> DataFrame:
    """The end state of repair, resolution and review in one join.

    A DOI that no publication has: PENDING without target. One that has: RESOLVED to its work; rows that already
    said so keep their time. NULL DOIs match nothing.
    """
    known = publications.where("doi is not null").groupBy(F.lower("doi").alias("__doi")).agg(F.min("work_id").alias("__work"))
    # By the expression: a column of its own would double the text that is shuffled.
    rows = references.join(known, F.lower("cited_doi") == F.col("__doi"), "left")
    there = F.col("__work").isNotNull()
    stale = there & ((F.col("status") == "PENDING") | ~F.col("cited_work_id").eqNullSafe(F.col("__work")))
    none = F.lit(None)
    return rows.withColumns(
        {
            "status": F.when(~there, "PENDING").when(stale, "RESOLVED").otherwise(F.col("status")),
            "cited_work_id": F.when(there, F.col("__work")).otherwise(none),
            "resolved_at": F.when(~there, none).when(stale, as_of).otherwise(F.col("resolved_at")),
        }
    ).drop("__doi", "__work")


def inconsistent(references: DataFrame, publications: DataFrame) -> DataFrame:
    """R6's dry run: references that the repair would change, with what it would make of them."""
    after = resolve(references.withColumn("__was", F.struct("status", "cited_work_id")), publications, F.lit(None).cast("string"))
    return after.where((F.col("__was.status") != F.col("status")) | ~F.col("__was.cited_work_id").eqNullSafe(F.col("cited_work_id"))).drop("__was")


def resolve_pending(references: DataFrame, publications: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    """Pending references whose DOI a publication has are resolved, with a limit those of the least ids alone; the others stay as they are."""
    known = publications.where("doi is not null").groupBy(F.lower("doi").alias("__doi")).agg(F.min("work_id").alias("__work"))
    rows = references.withColumn("__doi", F.lower("cited_doi")).join(known, "__doi", "left").drop("__doi")
    hit = (F.col("status") == "PENDING") & F.col("__work").isNotNull()
    if limit is not None:
        chosen = rows.where(hit).select("id").orderBy("id").limit(limit).withColumn("__chosen", F.lit(True))
        rows = rows.join(chosen, "id", "left")
        hit = hit & F.col("__chosen")
    hit = F.coalesce(hit, F.lit(False))
    new = {"status": F.when(hit, "RESOLVED").otherwise(F.col("status")), "cited_work_id": F.when(hit, F.col("__work")).otherwise(F.col("cited_work_id")), "resolved_at": F.when(hit, as_of).otherwise(F.col("resolved_at"))}
    return rows.withColumns(new).select(*references.columns)


def audit(references: DataFrame) -> DataFrame:
    """Counts by consistency, one row."""
    resolved = F.col("status") == "RESOLVED"
    return references.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(resolved).alias("resolved"), F.count_if(~resolved).alias("pending"),
        F.count_if(resolved & F.col("cited_work_id").isNull()).alias("resolved_without_target"),
    )
