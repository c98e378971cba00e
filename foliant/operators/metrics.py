"""Statistics of persons, organisations and venues, and the ten-year impact factor.

Sums over joins that fan out are inflated on purpose, as the statistics are defined that way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CITABLE = ("ARTICLE", "CONFERENCE", "CHAPTER", "BOOK")


def person_stats(authorships: DataFrame, publications: DataFrame) -> DataFrame:
    """G1."""
    rows = authorships.join(publications.select("work_id", "year"), "work_id", "left")
    one = F.when(F.col("is_corresponding") == 1, 1).otherwise(0).cast("long")
    by_work = rows.groupBy("person_id", "work_id").agg(F.sum(one).alias("c"), F.min("year").alias("lo"), F.max("year").alias("hi"))
    return by_work.groupBy("person_id").agg(F.count("work_id").alias("total_works"), F.sum("c").alias("corresponding"), F.min("lo").alias("first_year"), F.max("hi").alias("last_year"))


def h_index(authorships: DataFrame, works: DataFrame) -> DataFrame:
    """G2 by counting: persons' citations are counted by value first, so no window sorts all of a person's works."""
    rows = authorships.select("work_id", "person_id").join(works.select(F.col("id").alias("work_id"), "citation_count"), "work_id")
    by_value = rows.groupBy("person_id", "citation_count").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.partitionBy("person_id").orderBy(F.desc("citation_count")))
    reach = by_value.withColumn("h", F.least(above, F.col("citation_count")))
    return reach.groupBy("person_id").agg(F.sum(F.col("citation_count") * F.col("n")).alias("total_citations"), F.max("h").alias("h_index"))


def organization_stats(authorships: DataFrame, works: DataFrame, publications: DataFrame) -> DataFrame:
    """Distinct counts by two-stage grouping, sums over the fan-out."""
    pubs = publications.groupBy("work_id").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("open_access") == 1).alias("oa"))
    rows = authorships.where("affiliation_id is not null").join(works.select(F.col("id").alias("work_id"), "citation_count"), "work_id").join(pubs, "work_id", "left")
    times = F.coalesce("k", F.lit(1))
    pair = rows.groupBy("affiliation_id", "work_id").agg(F.sum(F.col("citation_count") * times).alias("c"), F.sum(F.coalesce("oa", F.lit(0))).alias("oa"))
    people = rows.select("affiliation_id", "person_id").distinct().groupBy("affiliation_id").agg(F.count("person_id").alias("researchers"))
    sums = pair.groupBy("affiliation_id").agg(F.count(F.lit(1)).alias("publications"), F.sum("c").alias("citations"), F.sum("oa").alias("open_access"))
    return people.join(sums, "affiliation_id")


def venue_stats(works: DataFrame, publications: DataFrame) -> DataFrame:
    """G4."""
    rows = publications.where("venue_id is not null").join(works.select(F.col("id").alias("work_id"), "citation_count"), "work_id")
    pair = rows.groupBy("venue_id", "work_id").agg(F.sum("citation_count").alias("c"), F.min("year").alias("lo"), F.max("year").alias("hi"))
    return pair.groupBy("venue_id").agg(F.count(F.lit(1)).alias("works"), F.sum("c").alias("cited_by"), F.min("lo").alias("start_year"), F.max("hi").alias("end_year"))


def impact_factors(publications: DataFrame, works: DataFrame, references: DataFrame, year: int) -> DataFrame:
    """Citations in `year` of what a venue published in the ten years before, by its citable items.

    A row for each venue with a publication in those years. Publications are grouped by work before the edges
    are joined, so an edge meets one row at either end.
    """
    window = publications.where(F.col("venue_id").isNotNull() & F.col("year").between(year - 10, year - 1))
    citable = works.where(F.col("work_type").isin(*CITABLE)).select(F.col("id").alias("work_id"))
    below = window.join(citable, "work_id", "left_semi").groupBy("venue_id").agg(F.count(F.lit(1)).alias("items"))
    citing = publications.where(F.col("year") == year).groupBy("work_id").agg(F.count(F.lit(1)).alias("k")).withColumnRenamed("work_id", "citing_work_id")
    edges = references.where("status = 'RESOLVED'").join(citing, "citing_work_id").groupBy("cited_work_id").agg(F.sum("k").alias("cites"))
    cited = window.groupBy("work_id", "venue_id").agg(F.count(F.lit(1)).alias("m")).join(edges.withColumnRenamed("cited_work_id", "work_id"), "work_id")
    above = cited.groupBy("venue_id").agg(F.sum(F.col("m") * F.col("cites")).alias("cites"))
    out = window.select("venue_id").distinct().join(below, "venue_id", "left").join(above, "venue_id", "left")
    ratio = F.round(F.coalesce("cites", F.lit(0)).cast("decimal(20,0)") / F.col("items"), 3).cast("decimal(10,3)")
    return out.select("venue_id", F.coalesce(F.when(F.col("items") > 0, ratio), F.lit(0).cast("decimal(10,3)")).alias("impact_factor"))


def write_back(rows: DataFrame, stats: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """Rows (id) with the columns of names (column of rows: column of stats) from stats by key; rows that stats don't list keep what they had."""
    s = stats.select(F.col(key).alias("id"), *[F.col(v).alias(f"__{k}") for k, v in names.items()], F.lit(True).alias("__there"))
    there = F.col("__there")
    joined = rows.join(s, "id", "left")
    old = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    return joined.withColumns({c: F.when(there, F.col(f"__{c}")).otherwise(old(c)) for c in names}).drop("__there", *[f"__{c}" for c in names])
