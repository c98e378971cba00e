"""The driver's tables in the shapes of the engine: projections in Spark, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = """
works AS (
  SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) % 50 AS citation_count,
         CASE WHEN o_orderkey % 4 = 0 THEN 'DATASET' ELSE 'ARTICLE' END AS work_type FROM orders),
pubs AS (
  SELECT o_orderkey AS id, o_orderkey AS work_id, o_custkey AS venue_id, year(o_orderdate) AS year, o_orderkey % 2 AS open_access,
         '10.1/' || o_orderkey AS doi FROM orders
  UNION ALL
  SELECT -o_orderkey, o_orderkey, o_custkey, year(o_orderdate) + 1, o_orderkey % 3, '10.2/' || o_orderkey FROM orders WHERE o_orderkey % 5 = 0),
auths AS (
  SELECT l_orderkey AS work_id, l_suppkey AS person_id, CASE WHEN l_linenumber <> 7 THEN l_partkey END AS affiliation_id,
         l_returnflag AS role, l_linenumber AS position, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_corresponding FROM lineitem),
refs AS (
  SELECT l_orderkey AS citing_work_id, CASE WHEN l_linenumber <> 6 THEN '10.1/' || (l_partkey * 10) END AS cited_doi,
         CASE WHEN l_linestatus = 'F' THEN l_partkey * 10 END AS cited_work_id,
         CASE WHEN l_linestatus = 'F' THEN 'RESOLVED' ELSE 'PENDING' END AS status, CAST(NULL AS VARCHAR) AS resolved_at, l_linenumber AS n FROM lineitem),
venues AS (
  SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS open_access, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 6 END AS llm_relevance
  FROM customer),
persons AS (SELECT s_suppkey AS id, s_suppkey % 12 AS h_index, s_name AS preferred_name FROM supplier),
subjects AS (
  SELECT p_partkey AS id, p_partkey % 40 AS parent_id, CASE WHEN p_partkey % 2 = 0 THEN 'OpenAlex' ELSE 'Scopus' END AS vocabulary, 'Topic' AS subject_type FROM part),
tiers AS (
  SELECT p_partkey AS subject_id, CASE WHEN p_partkey % 2 = 0 THEN 'OpenAlex' ELSE 'Scopus' END AS vocabulary,
         CASE WHEN p_partkey % 7 = 0 THEN 'N' ELSE 'A' END AS tier, CAST(p_partkey % 11 AS DOUBLE) AS weight FROM part),
vsubs AS (
  SELECT o_custkey AS venue_id, l_partkey AS subject_id, max(l_discount) AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""


class Tables:
    """The engine's tables over all rows of a folder of the driver's: every customer a venue, every part a subject with a tier."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def works(self) -> DataFrame:
        return self.raw("orders").selectExpr("o_orderkey id", "cast(floor(o_totalprice) as bigint) % 50 citation_count", "case when o_orderkey % 4 = 0 then 'DATASET' else 'ARTICLE' end work_type")

    @property
    def publications(self) -> DataFrame:
        o = self.raw("orders")
        first = o.selectExpr("o_orderkey id", "o_orderkey work_id", "o_custkey venue_id", "year(o_orderdate) year", "o_orderkey % 2 open_access", "concat('10.1/', o_orderkey) doi")
        return first.union(o.where("o_orderkey % 5 = 0").selectExpr("-o_orderkey", "o_orderkey", "o_custkey", "year(o_orderdate) + 1", "o_orderkey % 3", "concat('10.2/', o_orderkey)"))

    @property
    def authorships(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey work_id", "l_suppkey person_id", "case when l_linenumber <> 7 then l_partkey end affiliation_id", "l_returnflag role", "l_linenumber position", "case when l_linenumber = 1 then 1 else 0 end is_corresponding"
        )

    @property
    def references(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey citing_work_id", "case when l_linenumber <> 6 then concat('10.1/', l_partkey * 10) end cited_doi", "case when l_linestatus = 'F' then l_partkey * 10 end cited_work_id",
            "case when l_linestatus = 'F' then 'RESOLVED' else 'PENDING' end status", "cast(null as string) resolved_at", "l_linenumber n",
        )

    @property
    def venues(self) -> DataFrame:
        return self.raw("customer").selectExpr("c_custkey id", "c_name name", "case when c_custkey % 3 = 0 then 1 else 0 end open_access", "case when c_custkey % 2 = 0 then c_custkey % 6 end llm_relevance")

    @property
    def persons(self) -> DataFrame:
        return self.raw("supplier").selectExpr("s_suppkey id", "s_suppkey % 12 h_index", "s_name preferred_name")

    @property
    def subjects(self) -> DataFrame:
        return self.raw("part").selectExpr("p_partkey id", "p_partkey % 40 parent_id", "case when p_partkey % 2 = 0 then 'OpenAlex' else 'Scopus' end vocabulary", "'Topic' subject_type")

    @property
    def tiers(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey subject_id", "case when p_partkey % 2 = 0 then 'OpenAlex' else 'Scopus' end vocabulary", "case when p_partkey % 7 = 0 then 'N' else 'A' end tier", "cast(p_partkey % 11 as double) weight"
        )

    @property
    def venue_subjects(self) -> DataFrame:
        rows = self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.groupBy(F.col("o_custkey").alias("venue_id"), F.col("l_partkey").alias("subject_id")).agg(F.max("l_discount").alias("score"))
