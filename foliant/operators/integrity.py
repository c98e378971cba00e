"""Clean-up of core tables: orphans, compound persons, open access."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_orphans(parents: DataFrame, pk: str, *children: tuple[DataFrame, str]) -> DataFrame:
    """Parents that any child column names; all columns go through one distinct and one semi-join."""
    used = reduce(DataFrame.unionByName, [c.select(F.col(k).alias(pk)).where(F.col(pk).isNotNull()) for c, k in children])
    return parents.join(used.distinct(), pk, "left_semi")


def split_compound(persons: DataFrame) -> DataFrame:
    """(id, part) of names that hold commas; each part is trimmed and not blank."""
    parts = persons.where(F.col("preferred_name").contains(",")).select("id", F.explode(F.split("preferred_name", ",")).alias("part"))
    return parts.select("id", F.trim("part").alias("part")).where("part <> ''").distinct()


def open_access_from_venues(publications: DataFrame, venues: DataFrame) -> DataFrame:
    """Of publications in a stored venue, 0 becomes 1 where the venue is open, or a license or a SciELO number is known; NULL stays."""
    known = venues.select(F.col("id").alias("venue_id"), (F.col("open_access") == 1).alias("__open")).groupBy("venue_id").agg(F.coalesce(F.max("__open"), F.lit(False)).alias("__open"))
    rows = publications.join(known, "venue_id", "left")
    opened = F.col("__open")
    for c in ("license_url", "scielo_pid"):
        if c in publications.columns:
            opened = opened | (F.col("__open").isNotNull() & F.col(c).isNotNull())
    return rows.withColumn("open_access", F.when((F.col("open_access") == 0) & opened, 1).otherwise(F.col("open_access"))).drop("__open")
