"""Denormalised summaries (R22 to R24): children are aggregated before they are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def joined_text(rows: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """Values of a key in order, joined by spaces."""
    pair = F.array_sort(F.collect_list(F.struct(*order, value)))
    return rows.groupBy(key).agg(F.array_join(F.transform(pair, lambda x: x[value]), " ").alias(name))


def distinct_text(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """G14."""
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), " ").alias(name))


def top_subjects(venue_subjects: DataFrame, most: int = 10) -> DataFrame:
    """A venue's best subjects by score, NULLs last, ties to the lower id."""
    w = Window.partitionBy("venue_id").orderBy(F.desc_nulls_last("score"), "subject_id")
    return venue_subjects.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def json_rows(rows: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """A JSON array of objects, NULL values written out, in the order of the columns."""
    objects = F.array_sort(F.collect_list(F.struct(*columns)))
    return rows.groupBy(key).agg(F.to_json(objects, {"ignoreNullFields": "false"}).alias(name))


def publications(works: DataFrame, pubs: DataFrame, venues: DataFrame, authors: DataFrame, subjects: DataFrame) -> DataFrame:
    """Authors (work_id, id, name, role, position) and subjects (work_id, id, name) as text and JSON beside each publication.

    Works without either have NULL there. Columns of works and publications are carried along.
    """
    by_author = joined_text(authors, "work_id", "name", ["position"], "authors_search")
    subjects = subjects.withColumn("term", F.col("name"))
    if "position" not in subjects.columns:
        subjects = subjects.withColumn("position", F.col("id"))
    by_subject = joined_text(subjects, "work_id", "name", ["position"], "subjects_search")
    if "id" in authors.columns:
        by_author = by_author.join(json_rows(authors, "work_id", ["id", "name", "role"], "authors_json"), "work_id")
    if "id" in subjects.columns:
        by_subject = by_subject.join(json_rows(subjects, "work_id", ["id", "term"], "subjects_json"), "work_id")
    rows = works.withColumnRenamed("id", "work_id").join(pubs.withColumnRenamed("id", "publication_id"), "work_id")
    rows = rows.join(venues.select(F.col("id").alias("venue_id"), F.col("name").alias("venue_search")), "venue_id", "left")
    return rows.join(by_author, "work_id", "left").join(by_subject, "work_id", "left")


def persons(people: DataFrame, authorships: DataFrame, organizations: DataFrame) -> DataFrame:
    """Persons with the names of their organisations, each once, as text, and every affiliation as JSON."""
    placed = authorships.where("affiliation_id is not null").select("person_id", F.col("affiliation_id").alias("id")).join(organizations.select("id", "name", "type"), "id")
    names = distinct_text(placed, "person_id", "name", "affiliations_search")
    json = json_rows(placed, "person_id", ["id", "name", "type"], "current_affiliations_json")
    return people.withColumnRenamed("id", "person_id").join(names, "person_id", "left").join(json, "person_id", "left")


def venues(rows: DataFrame, organizations: DataFrame, venue_subjects: DataFrame, subjects: DataFrame, most: int = 10) -> DataFrame:
    """Venues with their publisher's name and their best subjects as JSON, the best first."""
    scored = venue_subjects.select("venue_id", "subject_id", "score").join(subjects.select(F.col("id").alias("subject_id"), "term"), "subject_id")
    top = top_subjects(scored, most).withColumn("id", F.col("subject_id"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id", "term", "score"))), lambda x: F.struct(x["id"].alias("id"), x["term"].alias("term"), x["score"].alias("score")))
    json = top.groupBy("venue_id").agg(F.to_json(ordered, {"ignoreNullFields": "false"}).alias("top_subjects_json"))
    named = rows.withColumnRenamed("id", "venue_id").join(organizations.select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher_search")), "publisher_id", "left")
    return named.join(json, "venue_id", "left")
