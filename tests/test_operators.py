"""Relational operators on micro-tables, and every registered query against its SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foliant.operators import citations, cleanup, keys, metrics, resolve, venues, works
from foliant.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(rows):
    def v(x):
        if x is None or x != x:
            return "NULL"
        return f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)[:60]

    return sorted(tuple(v(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, name):
    got = registry.QUERIES[name](spark, DATA)
    names = sorted(got.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(f"SELECT {', '.join(names)} FROM ({registry.ORACLES[name]})").fetchall()
    assert normal(got.select(*names).collect()) == normal(want)


def test_h_index(spark):
    works = spark.createDataFrame([(1, 5), (2, 3), (3, 3), (4, 1)], "id long, citation_count long")
    rows = spark.createDataFrame([(k, 7) for k in range(1, 5)], "work_id long, person_id long")
    assert tuple(metrics.h_index(rows, works).first()) == (7, 12, 3)


def test_references_end_state(spark):
    refs = spark.createDataFrame(
        [("10.1/gone", "RESOLVED", 7, "t"), ("10.1/a", "PENDING", None, None), ("10.1/a", "RESOLVED", 1, "t0"), (None, "RESOLVED", 7, "t")],
        "cited_doi string, status string, cited_work_id long, resolved_at string",
    )
    pubs = spark.createDataFrame([("10.1/A", 1)], "doi string, work_id long")
    out = {tuple(r) for r in citations.resolve(refs, pubs, F.lit("now")).collect()}
    assert out == {("10.1/gone", "PENDING", None, None), ("10.1/a", "RESOLVED", 1, "now"), ("10.1/a", "RESOLVED", 1, "t0"), (None, "PENDING", None, None)}


def test_skip_on_conflict(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id long, k string")
    out = {r.id: (r.k, r.skipped) for r in keys.skip_on_conflict(rows, "k", F.lit("a"), "id").collect()}
    assert out == {1: ("a", False), 2: ("y", True)}


def test_versions_and_duplicates(spark):
    up = lambda a, b: spark.range(1).select(keys.upgraded_version(F.lit(a), F.lit(b))).first()[0]
    assert up("acceptedVersion", "submittedVersion") == "acceptedVersion"
    assert up("acceptedVersion", "publishedVersion") == "publishedVersion"
    venues = spark.createDataFrame([(5, "i", None), (2, None, "i"), (9, "i", None)], "id long, issn string, eissn string")
    assert {tuple(r) for r in resolve.duplicate_issns(venues).collect()} == {(5, 2), (9, 2)}


def test_remap_keeps_one_row_a_key(spark):
    child = spark.createDataFrame([(1, 5, "own"), (1, 6, "moved"), (2, 6, "alone")], "work long, org long, note string")
    pairs = spark.createDataFrame([(6, 5)], "duplicate long, canonical long")
    assert {tuple(r) for r in resolve.remap(child, "org", pairs, ["work", "org"]).collect()} == {(1, 5, "own"), (2, 5, "alone")}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.ORACLES) <= set(entry.queries())


def test_venue_records(spark):
    stored = spark.createDataFrame([(1, "A", "JOURNAL", None, None), (2, " ", None, "x", "i2")], "id long, name string, aggregation_type string, type string, issn string")
    new = spark.createDataFrame([(1, "B", "BOOK", "i1"), (2, "C", "REPOSITORY", "i9")], "id long, name string, type string, issn string")
    got = venues.enrich_openalex(stored, new).select("id", "name", "type", "issn").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "A", "JOURNAL", "i1"), (2, "C", "REPOSITORY", "i2")]
    records = spark.createDataFrame([(10, "Z", "I2"), (11, "N", "i7"), (12, "N", "i7")], "rid long, name string, issn string")
    all_, ids = venues.create_missing(stored.drop("type"), records, ["issn"])
    assert {r.rid: r.id for r in ids.collect()} == {10: 2, 11: 3, 12: 3} and all_.count() == 3


def test_role_audit(spark):
    cols = "work_id long, person_id long, role string, position int, affiliation_id long, is_corresponding int"
    held = spark.createDataFrame([(1, 1, "AUTHOR", 1, None, 0), (2, 1, "AUTHOR", 1, None, 0), (3, 1, "AUTHOR", 1, None, 0), (3, 1, "EDITOR", 1, None, 0)], cols)
    want = spark.createDataFrame([(1, 1, "author", 1, None, None), (2, 1, "EDITOR", 2, 5, 1), (3, 1, "TRANSLATOR", 1, None, None), (9, 1, "AUTHOR", 1, None, None)], cols)
    stored = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert {r.work_id: r.status for r in works.audit_roles(held, want, stored).collect()} == {1: "unchanged", 2: "changed", 3: "conflict", 9: "missing_db_record"}
    rows, _ = works.reconcile_authorships(held, want)
    assert [tuple(r) for r in rows.where("work_id = 2").collect()] == [(2, 1, "EDITOR", 2, 5, 1)]


def test_many_rows_in_few_bytes_are_not_gathered_by_the_driver(spark, tmp_path):
    registry.QUERIES["g24_scored_venues"](spark, DATA)
    spark.range(1_000_000).selectExpr("id", "id % 7 s").coalesce(1).write.parquet(str(tmp_path / "t"))
    d = spark.read.parquet(str(tmp_path / "t"))
    plan = d.join(d.select("id", (F.col("s") + 1).alias("x")), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_records_are_built_by_more_than_one_task(spark):
    keys = registry.table(spark, DATA, "orders").select("o_orderkey").coalesce(1)
    assert registry.spread(keys).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1


def test_sizes_of_joins_and_tasks(spark):
    """What a shuffle has measured at more than 1 MB isn't gathered by the driver, and a task takes 16 MB of a shuffle; what a session sets itself stays."""
    own = spark.newSession()
    registry.QUERIES["g1_person_stats"](own, DATA)
    rows = own.range(300_000).selectExpr("id k", "id * 7 v").repartition(4)
    joined = rows.groupBy("k").agg(F.max("v").alias("v")).join(rows.selectExpr("k + 5 k", "v w").groupBy("k").agg(F.max("w").alias("w")), "k")
    assert joined.count() == 299_995
    joined.collect()
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"
    set_ = spark.newSession()
    set_.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8MB")
    registry.QUERIES["g1_person_stats"](set_, DATA)
    assert set_.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8MB"


def test_children_are_not_shuffled_for_their_parents(spark):
    own = spark.newSession()
    registry.QUERIES["g1_person_stats"](own, DATA)
    parents = {n: own.range(200_000).withColumn("x", F.lit(1)) for n in ("works", "persons")}
    wrote = own.range(400_000).selectExpr("case when id > 1 then id % 200000 + if(id = 7, 900000, 0) end work_id", "if(id = 9, null, if(id = 8, -1, id % 200000)) person_id", "cast(id as string) role")
    after = cleanup.core_data(parents | {"authorships": wrote})["authorships"]
    assert sorted(r.role for r in wrote.join(after.select("role"), "role", "left_anti").collect()) == ["0", "1", "7", "8", "9"]
    assert after.count() == 399_995 and after.columns == wrote.columns
    assert "hashpartitioning" not in after._jdf.queryExecution().executedPlan().toString()
