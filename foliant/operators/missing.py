"""Works that a catalogue has and the store lacks, by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import issn, lookup_issn
from ..functions.values import year_bucket, year_within


def tasks(rows: DataFrame) -> DataFrame:
    """Key, kind: one task a lookup key of rows (issn, eissn); a key that comes as issn and as eissn is an issn."""
    found = rows.select(lookup_issn(F.col("issn"), F.col("eissn")).alias("k")).where("k is not null").select("k.*")
    return found.groupBy("key").agg(F.max("kind").alias("kind"))


def by_year(items: DataFrame, excluded: tuple[str, ...]) -> DataFrame:
    """Issn, year, doi of a catalogue's items (issn, doi, type, and three dates as arrays); excluded types and items without DOI go."""
    rows = items.where(F.coalesce("doi", F.lit("")) != "").where(~F.coalesce("type", F.lit("")).isin(*excluded))
    return rows.select("issn", year_bucket(F.col("print"), F.col("online"), F.col("issued")).alias("year"), F.lower("doi").alias("doi")).distinct()


def cached(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """What is cached (issn, year, doi) within the years asked for; years that aren't numbers always count."""
    return rows.where(year_within(F.col("year"), low, high))


def stored_dois(publications: DataFrame, venues: DataFrame, kind: str = "issn") -> DataFrame:
    """Issn, doi of the stored publications of venues with that issn or eissn; lower case."""
    named = venues.select(F.col("id").alias("venue_id"), issn(F.col(kind)).alias("issn")).where("issn is not null")
    return publications.where("doi <> ''").join(named, "venue_id").select("issn", F.lower("doi").alias("doi")).distinct()


def missing(catalogue: DataFrame, stored: DataFrame, filtered: list[DataFrame]) -> DataFrame:
    """Issn, doi of the catalogue that is neither stored nor in any of the ledgers of filtered works."""
    known = stored.select("issn", "doi")
    for ledger in filtered:
        known = known.unionByName(ledger.select("issn", F.lower("doi").alias("doi")))
    return catalogue.select("issn", "doi").distinct().join(known.distinct(), ["issn", "doi"], "left_anti")


def years_of(lacking: DataFrame, cache: DataFrame, other: str = "unknown") -> DataFrame:
    """Issn, year, doi of what is missing by every year under which it is cached, `other` where it isn't."""
    years = cache.select("issn", "year", F.lower(F.trim("doi")).alias("doi")).distinct()
    return lacking.join(years, ["issn", "doi"], "left").select("issn", F.coalesce("year", F.lit(other)).alias("year"), "doi")


def split_by_index(wanted: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items that are wanted, wanted DOIs that no item has), by lower-case DOI."""
    key = F.lower("doi")
    ask = wanted.select(key.alias("key")).distinct()
    hit = items.withColumn("key", key).join(ask, "key", "left_semi").drop("key")
    return hit, ask.join(items.select(key.alias("key")).distinct(), "key", "left_anti").select(F.col("key").alias("doi"))


def source_ids(issns: DataFrame, venues: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Issn, source_id: that of a stored venue with the ISSN in either column, else what was looked up elsewhere."""
    pairs = venues.where("openalex_id is not null").select("openalex_id", F.explode(F.array(issn(F.col("issn")), issn(F.col("eissn")))).alias("issn")).where("issn is not null")
    own = pairs.groupBy("issn").agg(F.min("openalex_id").alias("__own"))
    other = looked_up.groupBy("issn").agg(F.min("source_id").alias("__other"))
    return issns.join(own, "issn", "left").join(other, "issn", "left").select("issn", F.coalesce("__own", "__other").alias("source_id"))
