"""The venue ranking (R21): seven components, each a pure function of the tables, in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import capped_ratio, confidence, rounded
from ..scratch import Scratch


def subject_scores(venues: DataFrame, venue_subjects: DataFrame, subjects: DataFrame, tiers: DataFrame) -> DataFrame:
    """venue_id, subject_score: best direct tier, or the mean over topics of their parents' tiers if that is more, less penalties."""
    t = tiers.select("subject_id", "vocabulary", "tier", "weight")
    direct = venue_subjects.join(t.where("vocabulary = 'Scopus'"), "subject_id").groupBy("venue_id").agg(F.max("weight").alias("direct"))
    topics = subjects.where("vocabulary = 'OpenAlex' and subject_type = 'Topic'").select(F.col("id").alias("subject_id"), "parent_id")
    parents = t.where("vocabulary = 'OpenAlex' and tier <> 'N'").select(F.col("subject_id").alias("parent_id"), "weight")
    mean = venue_subjects.join(topics, "subject_id").join(parents, "parent_id", "left").groupBy("venue_id").agg((F.sum(F.coalesce("weight", F.lit(0.0))) / F.count(F.lit(1))).alias("mean"))
    less = venue_subjects.join(t.where("tier = 'N'"), "subject_id").groupBy("venue_id").agg(F.sum("weight").alias("penalty"))
    ids = venues.select(F.col("id").alias("venue_id"))
    rows = ids.join(direct, "venue_id", "left").join(mean, "venue_id", "left").join(less, "venue_id", "left")
    best = F.greatest(F.coalesce("direct", F.lit(0.0)), F.coalesce("mean", F.lit(0.0)))
    after = F.when(best > 0, F.greatest(F.lit(0.0), best - F.coalesce("penalty", F.lit(0.0)))).otherwise(best)
    return rows.select("venue_id", after.alias("subject_score"))


def _people(authorships: DataFrame, publications: DataFrame) -> DataFrame:
    works = publications.where("venue_id is not null").select("work_id", "venue_id").distinct()
    return works.join(authorships.select("work_id", "person_id", "affiliation_id"), "work_id")


def authorship_scores(authorships: DataFrame, publications: DataFrame, persons: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Share of a venue's authors with an h-index of 5 or more; distinct by a first grouping, not by expanding rows. Of a person given twice the greatest h-index counts."""
    people = _people(authorships, publications) if people is None else people
    pairs = people.select("venue_id", "person_id").distinct()
    rows = pairs.join(persons.groupBy(F.col("id").alias("person_id")).agg(F.max("h_index").alias("h_index")), "person_id")
    by = rows.groupBy("venue_id").agg(F.count_if(F.col("h_index") >= 5).alias("x"), F.count(F.lit(1)).alias("n"))
    return by.select("venue_id", rounded(capped_ratio(F.col("x"), F.col("n"), 10.0) * confidence(F.col("n")), 3).alias("authorship_score"))


def core_institutions(authorships: DataFrame, publications: DataFrame, venues: DataFrame, most: int = 500, people: DataFrame | None = None) -> DataFrame:
    """The organisations with most authors in relevant venues; ties go to the lower id."""
    good = venues.where("llm_relevance >= 4").select(F.col("id").alias("venue_id"))
    people = _people(authorships, publications) if people is None else people
    rows = people.where("affiliation_id is not null").join(good, "venue_id", "left_semi")
    by = rows.select("affiliation_id", "person_id").distinct().groupBy("affiliation_id").agg(F.count("person_id").alias("n"))
    return by.orderBy(F.desc("n"), "affiliation_id").limit(most).select("affiliation_id")


def affiliation_scores(authorships: DataFrame, publications: DataFrame, venues: DataFrame, people: DataFrame | None = None, unplaced: float | None = None) -> DataFrame:
    """Share of authors with an affiliation that come from core institutions; at most 500 of those, so they are broadcast.

    Authorships of nobody don't count. unplaced is the ratio where no author has an affiliation: NULL by F74's rule, the cap for a least() that skips NULLs.
    """
    people = _people(authorships, publications) if people is None else people
    core = F.broadcast(core_institutions(authorships, publications, venues, people=people).withColumn("core", F.lit(1)))
    rows = people.join(core, "affiliation_id", "left")
    flags = rows.groupBy("venue_id", "person_id").agg(F.max("core").alias("core"), F.max(F.col("affiliation_id").isNotNull()).alias("placed"))
    somebody = F.col("person_id").isNotNull()
    by = flags.groupBy("venue_id").agg(F.count_if(somebody & F.col("core").isNotNull()).alias("x"), F.count_if(somebody & F.col("placed")).alias("n"), F.count("person_id").alias("all"))
    ratio = F.coalesce(capped_ratio(F.col("x"), F.col("n"), 15.0), F.lit(unplaced).cast("double"))
    return by.select("venue_id", rounded(ratio * confidence(F.col("all")), 3).alias("affiliation_score"))


def citation_scores(references: DataFrame, publications: DataFrame, scores: DataFrame) -> DataFrame:
    """Share of resolved outgoing references to venues with a subject score of 5 or more; pre-aggregated by venue pair."""
    good = scores.select("venue_id", (F.col("subject_score") >= 5).alias("good"))
    target = publications.join(good, "venue_id", "left").groupBy("work_id").agg(F.count(F.lit(1)).alias("m"), F.count_if("good").alias("g"))
    edges = references.where("cited_work_id is not null").groupBy("citing_work_id", "cited_work_id").agg(F.count(F.lit(1)).alias("e"))
    out = edges.join(target.withColumnRenamed("work_id", "cited_work_id"), "cited_work_id").groupBy("citing_work_id").agg(F.sum(F.col("e") * F.col("m")).alias("n"), F.sum(F.col("e") * F.col("g")).alias("x"))
    by = publications.where("venue_id is not null").select(F.col("work_id").alias("citing_work_id"), "venue_id").join(out, "citing_work_id").groupBy("venue_id").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    return by.select("venue_id", rounded(capped_ratio(F.col("x"), F.col("n"), 40.0), 3).alias("citation_score"))


def rank(venues, venue_subjects, subjects, tiers, authorships, publications, persons, references, unplaced: float | None = None) -> DataFrame:
    """All components and the total of every venue; unplaced as in affiliation_scores(). Who published where, and the subject scores, which several components read, are written down once."""
    scratch = Scratch(venues.sparkSession, "ranking")
    subject = scratch.write(subject_scores(venues, venue_subjects, subjects, tiers), "subject")
    people = scratch.write(_people(authorships, publications), "people")
    parts = [authorship_scores(authorships, publications, persons, people), affiliation_scores(authorships, publications, venues, people, unplaced), citation_scores(references, publications, subject)]
    rows = venues.select(F.col("id").alias("venue_id"), "open_access", "llm_relevance").join(subject, "venue_id")
    for p in parts:
        rows = rows.join(p, "venue_id", "left")
    on = F.col("subject_score") > 0
    zero = F.lit(0.0)
    given = lambda c: F.when(on, F.coalesce(c, zero)).otherwise(zero).alias(c)
    oa = F.when(on & (F.col("open_access") == 1), 0.2).otherwise(zero).alias("oa_score")
    llm = (F.coalesce("llm_relevance", F.lit(0)) * 2).cast("double").alias("llm_score")
    out = rows.select("venue_id", "subject_score", oa, *map(given, ["authorship_score", "affiliation_score", "citation_score"]), llm)
    total = sum([F.col(c) for c in out.columns[2:]], F.col("subject_score"))
    return out.withColumn("total_score", F.when(on | (F.col("llm_score") > 0), rounded(total, 3)).otherwise(zero))


def scored(ranking: DataFrame) -> DataFrame:
    """How many venues have a score."""
    return ranking.agg(F.count_if(F.col("total_score") > 0).alias("n"))
