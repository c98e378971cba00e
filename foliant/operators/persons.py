"""Persons: compound names taken apart, signatures, family and given names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .integrity import split_compound
from .keys import insert_ignore, new_ids, skip_on_conflict

#: Position of authorships that come from a name taken apart. Fixed value.
SPLIT_POSITION = 99


def split_persons(persons: DataFrame, authorships: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persons, authorships) after names with commas were taken apart.

    Each part is a person, a stored one where one has that name (case and accents aside). Every authorship of the
    compound person is repeated for its parts, as AUTHOR at position 99, unless that person is author there already. The
    compound persons go; their own authorships stay behind for the clean-up (R4).
    """
    parts = split_compound(persons).withColumn("name", text.same_letters(F.col("part")))
    named = persons.withColumn("name", text.same_letters(F.col("preferred_name")))
    fresh = parts.join(named.select("name").distinct(), "name", "left_anti").groupBy("name").agg(F.min("part").alias("preferred_name"))
    made = new_ids(persons, "id", fresh.select("preferred_name"), "preferred_name")
    everyone = persons.unionByName(made.select("id", "preferred_name"), allowMissingColumns=True)
    links = parts.select("id", "name").join(everyone.select(F.col("id").alias("new_id"), text.same_letters(F.col("preferred_name")).alias("name")), "name").select("id", "new_id").distinct()
    added = authorships.select("work_id", F.col("person_id").alias("id")).distinct().join(links, "id")
    added = added.select("work_id", F.col("new_id").alias("person_id"), F.lit("AUTHOR").alias("role"), F.lit(SPLIT_POSITION).alias("position")).distinct()
    types = dict(authorships.dtypes)
    blank = [F.lit(None).cast(types[c]).alias(c) if c not in added.columns else F.col(c).cast(types[c]).alias(c) for c in authorships.columns]
    kept = everyone.join(parts.select("id").distinct(), "id", "left_anti")
    return kept.select(*persons.columns), insert_ignore(authorships, added.select(*blank), ["work_id", "person_id", "role"])


def rebuild_signatures(persons: DataFrame, signatures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persons, signatures); signatures that aren't stored are added, persons without one keep what they had."""
    made = persons.select("id", text.signature(F.col("preferred_name")).alias("signature")).where("signature is not null and trim(signature) <> ''")
    fresh = made.select("signature").distinct().join(signatures.select("signature"), "signature", "left_anti")
    everything = signatures.select("id", "signature").unionByName(new_ids(signatures, "id", fresh, "signature").select("id", "signature"))
    found = made.join(everything.groupBy("signature").agg(F.min("id").alias("found")), "signature").select("id", "found")
    out = persons.join(found, "id", "left").withColumn("signature_id", F.coalesce("found", "signature_id")).drop("found")
    return out.select(*persons.columns), everything


def rename_family(persons: DataFrame, wrong: str, right: str) -> DataFrame:
    """The family name wrong becomes right, also at the end of the preferred names of all whose family name is then right.

    A preferred name that another person has stays as it was.
    """
    same = lambda c, v: text.same_letters(c) == text.same_letters(F.lit(v))
    rows = persons.withColumn("family_name", F.when(same(F.col("family_name"), wrong), F.lit(right)).otherwise(F.col("family_name")))
    new = F.when(same(F.col("family_name"), right), text.renamed(F.col("preferred_name"), wrong, right)).otherwise(F.col("preferred_name"))
    return skip_on_conflict(rows, "preferred_name", new, "id").drop("skipped").select(*persons.columns)


def repair_names(persons: DataFrame) -> DataFrame:
    """Family and given names anew from the preferred name, where there is one."""
    made = text.family_and_given(F.col("preferred_name"))
    some = F.col("preferred_name").isNotNull()
    new = {c: F.when(some, made[c]).otherwise(F.col(c)) for c in ("family_name", "given_names")}
    return persons.withColumns(new).select(*persons.columns)
