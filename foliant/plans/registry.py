"""Queries over the driver's tables and the DuckDB SQL that each must match."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions import identifiers as ids
from ..functions import text, values
from ..operators import citations, integrity, keys, metrics, ranking, resolve, summaries
from ..scratch import joins_by_size, tasks_by_size
from .adapters import SQL, Tables

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def add(f):
        @functools.wraps(f)
        def run(spark, sf_dir):
            joins_by_size(spark)
            tasks_by_size(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(keys: DataFrame) -> DataFrame:
    """Keys of records that are yet to be built, dealt over tasks of some 100,000: a file of many keys is one split, and would be one task's work."""
    return keys.repartition(max(keys.sparkSession.sparkContext.defaultParallelism, keys.count() // 100_000), keys.columns[0])



def shaped(value: Column, have: DataType, want: DataType) -> Column:
    """A record as its schema has it, of whose fields it says some: the rest are NULL. As if it were written as JSON and read again, without doing so."""
    if isinstance(want, StructType):
        mine = {f.name: f.dataType for f in have.fields}
        fields = [(shaped(value[f.name], mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType) and have != want:
        return F.transform(value, lambda x: shaped(x, have.elementType, want.elementType))
    return value.cast(want)


def as_schema(rows: DataFrame, sql: str, schema: str) -> Column:
    """The record that sql makes of a row, shaped as schema."""
    want = rows.sparkSession.sql(f"select cast(null as {schema}) r").schema["r"].dataType
    return shaped(F.expr(sql), rows.select(F.expr(sql).alias("r")).schema["r"].dataType, want)


def over(name: str, sql: str):
    """Register a query of Tables with SQL that may read the adapters' tables."""
    return query(name, f"WITH {SQL} {sql}")


@query(
    "g2_h_index",
    """
    WITH c AS (
      SELECT l.l_suppkey AS person_id, CAST(floor(o.o_totalprice) AS BIGINT) % 50 AS citations
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY citations DESC) AS rn FROM c)
    SELECT person_id, CAST(sum(citations) AS BIGINT) AS total_citations,
           CAST(max(CASE WHEN citations >= rn THEN rn ELSE 0 END) AS BIGINT) AS h_index
    FROM r GROUP BY person_id
    """,
)
def g2_h_index(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return metrics.h_index(t.authorships, t.works)


@over(
    "g1_person_stats",
    """SELECT a.person_id, count(DISTINCT a.work_id) AS total_works, CAST(sum(is_corresponding) AS BIGINT) AS corresponding,
       min(year) AS first_year, max(year) AS last_year FROM auths a LEFT JOIN pubs p ON a.work_id = p.work_id GROUP BY 1""",
)
def g1_person_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return metrics.person_stats(t.authorships, t.publications).withColumns({c: F.col(c).cast("long") for c in ("first_year", "last_year")})


@over(
    "g3_organization_stats",
    """SELECT affiliation_id, count(DISTINCT person_id) AS researchers, count(DISTINCT a.work_id) AS publications,
       CAST(sum(citation_count) AS BIGINT) AS citations, CAST(sum(CASE WHEN open_access = 1 THEN 1 ELSE 0 END) AS BIGINT) AS open_access
       FROM auths a JOIN works w ON a.work_id = w.id LEFT JOIN pubs p ON a.work_id = p.work_id WHERE affiliation_id IS NOT NULL GROUP BY 1""",
)
def g3_organization_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return metrics.organization_stats(t.authorships, t.works, t.publications)


@over(
    "g4_venue_stats",
    """SELECT venue_id, count(DISTINCT w.id) AS works, CAST(sum(citation_count) AS BIGINT) AS cited_by, CAST(min(year) AS BIGINT) AS start_year, CAST(max(year) AS BIGINT) AS end_year
       FROM works w JOIN pubs p ON w.id = p.work_id WHERE venue_id IS NOT NULL GROUP BY 1""",
)
def g4_venue_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return metrics.venue_stats(t.works, t.publications).withColumns({c: F.col(c).cast("long") for c in ("start_year", "end_year")})


@over(
    "r12_impact_factors",
    """, d AS (SELECT venue_id, count(*) AS n FROM pubs p JOIN works w ON p.work_id = w.id WHERE year BETWEEN 1988 AND 1997 AND work_type IN ('ARTICLE','CONFERENCE','CHAPTER','BOOK') GROUP BY 1),
    c AS (SELECT b.venue_id, count(*) AS n FROM refs r JOIN pubs a ON r.citing_work_id = a.work_id JOIN pubs b ON r.cited_work_id = b.work_id
          WHERE status = 'RESOLVED' AND a.year = 1998 AND b.year BETWEEN 1988 AND 1997 GROUP BY 1)
    SELECT v.venue_id, CAST(CASE WHEN coalesce(d.n, 0) > 0 THEN round(coalesce(c.n, 0) / d.n, 3) ELSE 0 END AS DOUBLE) AS impact_factor
    FROM (SELECT DISTINCT venue_id FROM pubs WHERE year BETWEEN 1988 AND 1997) v LEFT JOIN d USING (venue_id) LEFT JOIN c USING (venue_id)""",
)
def r12_impact_factors(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return metrics.impact_factors(t.publications, t.works, t.references, 1998).withColumn("impact_factor", F.col("impact_factor").cast("double"))


@over(
    "r9_references",
    """, k AS (SELECT lower(doi) AS d, min(work_id) AS w FROM pubs GROUP BY 1)
    SELECT citing_work_id, cited_doi, n,
      CASE WHEN w IS NULL THEN 'PENDING' WHEN status = 'PENDING' OR cited_work_id IS DISTINCT FROM w THEN 'RESOLVED' ELSE status END AS status, w AS cited_work_id,
      CASE WHEN w IS NULL THEN NULL WHEN status = 'PENDING' OR cited_work_id IS DISTINCT FROM w THEN 'now' ELSE resolved_at END AS resolved_at
    FROM refs LEFT JOIN k ON lower(cited_doi) = k.d""",
)
def r9_references(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return citations.resolve(t.references, t.publications, F.lit("now"))


@over(
    "g16_reference_audit",
    """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'RESOLVED') AS resolved, count(*) FILTER (WHERE status <> 'RESOLVED') AS pending,
       count(*) FILTER (WHERE status = 'RESOLVED' AND cited_work_id IS NULL) AS resolved_without_target FROM refs""",
)
def g16_reference_audit(spark, sf_dir):
    return citations.audit(Tables(spark, sf_dir).references)


@over(
    "r21_subject_scores",
    """, a AS (SELECT venue_id, max(weight) AS x FROM vsubs JOIN tiers USING (subject_id) WHERE vocabulary = 'Scopus' GROUP BY 1),
    b AS (SELECT venue_id, sum(coalesce(weight, 0)) / count(*) AS x FROM vsubs v JOIN subjects s ON v.subject_id = s.id
          LEFT JOIN tiers t ON s.parent_id = t.subject_id AND t.vocabulary = 'OpenAlex' AND t.tier <> 'N' WHERE s.vocabulary = 'OpenAlex' GROUP BY 1),
    c AS (SELECT venue_id, sum(weight) AS x FROM vsubs JOIN tiers USING (subject_id) WHERE tier = 'N' GROUP BY 1),
    s AS (SELECT v.id AS venue_id, greatest(coalesce(a.x, 0), coalesce(b.x, 0)) AS x, coalesce(c.x, 0) AS p
          FROM venues v LEFT JOIN a ON a.venue_id = v.id LEFT JOIN b ON b.venue_id = v.id LEFT JOIN c ON c.venue_id = v.id)
    SELECT venue_id, round(CASE WHEN x > 0 THEN greatest(0, x - p) ELSE x END, 6) AS subject_score FROM s""",
)
def r21_subject_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ranking.subject_scores(t.venues, t.venue_subjects, t.subjects, t.tiers).withColumn("subject_score", values.rounded(F.col("subject_score"), 6))


@over(
    "g9_authorship_scores",
    """SELECT venue_id, round(least(count(DISTINCT CASE WHEN h_index >= 5 THEN person_id END) * 100.0 / nullif(count(DISTINCT person_id), 0) / 10.0, 2.0)
       * least(1.0, ln(1 + count(DISTINCT person_id)) / ln(51)), 3) AS authorship_score
       FROM pubs p JOIN auths a ON a.work_id = p.work_id JOIN persons e ON a.person_id = e.id WHERE venue_id IS NOT NULL GROUP BY 1""",
)
def g9_authorship_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ranking.authorship_scores(t.authorships, t.publications, t.persons)


@over(
    "g10_citation_scores",
    """, s AS (SELECT id AS venue_id, id % 10 AS subject_score FROM venues)
    SELECT a.venue_id, round(least(count(CASE WHEN subject_score >= 5 THEN 1 END) * 100.0 / nullif(count(*), 0) / 40.0, 2.0), 3) AS citation_score
    FROM refs r JOIN pubs a ON r.citing_work_id = a.work_id JOIN pubs b ON r.cited_work_id = b.work_id LEFT JOIN s ON b.venue_id = s.venue_id
    WHERE a.venue_id IS NOT NULL AND r.cited_work_id IS NOT NULL GROUP BY 1""",
)
def g10_citation_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ranking.citation_scores(t.references, t.publications, t.venues.selectExpr("id venue_id", "id % 10 subject_score"))


@over(
    "w2_top_subjects",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY score DESC NULLS LAST, subject_id) AS rank FROM vsubs) WHERE rank <= 10""",
)
def w2_top_subjects(spark, sf_dir):
    return summaries.top_subjects(Tables(spark, sf_dir).venue_subjects).withColumn("rank", F.col("rank").cast("long"))


@query(
    "g13_joined_text",
    """SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS said FROM conversations WHERE text IS NOT NULL GROUP BY 1""",
)
def g13_joined_text(spark, sf_dir):
    return summaries.joined_text(table(spark, sf_dir, "conversations").where("text is not null"), "conv_id", "text", ["turn"], "said")


@query(
    "g14_distinct_text",
    """SELECT conv_id, string_agg(role, ' ' ORDER BY role) AS roles FROM (SELECT DISTINCT conv_id, role FROM conversations) GROUP BY 1""",
)
def g14_distinct_text(spark, sf_dir):
    return summaries.distinct_text(table(spark, sf_dir, "conversations"), "conv_id", "role", "roles")


@over(
    "m14_open_access",
    """SELECT p.id, p.work_id, CASE WHEN p.open_access = 0 AND v.open_access = 1 THEN 1 ELSE p.open_access END AS open_access FROM pubs p LEFT JOIN venues v ON p.venue_id = v.id""",
)
def m14_open_access(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return integrity.open_access_from_venues(t.publications, t.venues).select("id", "work_id", "open_access")


@over("j6_orphans", "SELECT id FROM persons WHERE id IN (SELECT person_id FROM auths WHERE role = 'R') OR id IN (SELECT id * 3 FROM venues)")
def j6_orphans(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return integrity.without_orphans(t.persons, "id", (t.authorships.where("role = 'R'"), "person_id"), (t.venues.selectExpr("id * 3 x"), "x")).select("id")


@query(
    "r3_split_compound",
    """SELECT DISTINCT id, trim(part) AS part FROM (SELECT s_suppkey AS id, unnest(string_split(s_name || ', ' || s_nationkey || ',', ',')) AS part FROM supplier) WHERE trim(part) <> ''""",
)
def r3_split_compound(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "concat(s_name, ', ', s_nationkey, ',') preferred_name")
    return integrity.split_compound(rows)


@over(
    "m1_insert_ignore",
    """, e AS (SELECT person_id AS p, affiliation_id AS a, min(work_id) AS w FROM auths WHERE role = 'A' GROUP BY 1, 2),
    n AS (SELECT person_id AS p, affiliation_id AS a, min(work_id) AS w FROM auths WHERE role <> 'A' GROUP BY 1, 2)
    SELECT * FROM e UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.p = n.p AND e.a IS NOT DISTINCT FROM n.a)""",
)
def m1_insert_ignore(spark, sf_dir):
    rows = Tables(spark, sf_dir).authorships.selectExpr("role", "person_id p", "affiliation_id a", "work_id w")
    existing = rows.where("role = 'A'").groupBy("p", "a").agg(F.min("w").alias("w"))
    return keys.insert_ignore(existing, rows.where("role <> 'A'").select("p", "a", "w"), ["p", "a"], ["w"])


@query(
    "m2_skip_on_conflict",
    """WITH t AS (SELECT c_custkey AS id, 'v' || (c_custkey % 700) AS k, 'v' || (c_custkey % 500) AS n FROM customer),
    r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY (n = k) DESC, id) AS rn FROM t)
    SELECT id, CASE WHEN rn > 1 AND n <> k THEN k ELSE n END AS k, rn > 1 AND n <> k AS skipped FROM r""",
)
def m2_skip_on_conflict(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "concat('v', c_custkey % 700) k")
    return keys.skip_on_conflict(rows, "k", F.concat(F.lit("v"), (F.col("id") % 500).cast("string")), "id")


@query(
    "m5_merge_policies",
    """WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, c_mktsegment AS kind, c_nationkey AS h FROM customer WHERE c_custkey % 3 < 2),
    b AS (SELECT c_custkey AS id, 'in ' || c_name AS name, CASE WHEN c_custkey % 5 > 0 THEN 'K' END AS kind, c_nationkey + c_custkey % 4 - 2 AS h FROM customer WHERE c_custkey % 3 > 0)
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.name IS NULL OR trim(a.name) = '' THEN coalesce(b.name, a.name) ELSE a.name END AS name, coalesce(b.kind, a.kind) AS kind,
    CASE WHEN a.id IS NOT NULL THEN greatest(a.h, b.h) ELSE b.h END AS h FROM a FULL JOIN b ON a.id = b.id""",
)
def m5_merge_policies(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 < 2").selectExpr("c_custkey id", "case when c_custkey % 2 = 0 then c_name end name", "c_mktsegment kind", "c_nationkey h")
    new = c.where("c_custkey % 3 > 0").selectExpr("c_custkey id", "concat('in ', c_name) name", "case when c_custkey % 5 > 0 then 'K' end kind", "cast(c_nationkey + c_custkey % 4 - 2 as int) h")
    return keys.merge(old, new, ["id"], {"name": "fill", "kind": "overwrite", "h": "max"}).withColumn("h", F.col("h").cast("long"))


@query(
    "m15_new_ids",
    """SELECT p_partkey AS rid, p_brand AS key, 1000 + dense_rank() OVER (ORDER BY p_brand) AS id FROM part""",
)
def m15_new_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey rid", "p_brand key")
    existing = spark.createDataFrame([(1000,)], "id long")
    return keys.new_ids(existing, "id", rows, "key")


@query(
    "j24_ladder",
    """WITH e AS (SELECT s_suppkey AS eid, 'o' || (s_suppkey % 40) AS orcid, lower(s_name) AS name FROM supplier),
    r AS (SELECT c_custkey AS rid, CASE WHEN c_custkey % 2 = 0 THEN 'o' || (c_custkey % 60) END AS orcid, 'supplier#' || right('000000000' || (c_custkey % 300), 9) AS name FROM customer),
    m AS (SELECT rid, 0 AS k, min(eid) AS eid FROM r JOIN e USING (orcid) GROUP BY 1 UNION ALL SELECT rid, 1, min(eid) FROM r JOIN e USING (name) GROUP BY 1)
    SELECT rid, arg_min(eid, k) AS eid, CASE WHEN min(k) = 0 THEN 'orcid' ELSE 'name' END AS rung FROM m GROUP BY rid""",
)
def j24_ladder(spark, sf_dir):
    e = table(spark, sf_dir, "supplier").selectExpr("s_suppkey eid", "concat('o', s_suppkey % 40) orcid", "lower(s_name) name")
    r = table(spark, sf_dir, "customer").selectExpr("c_custkey rid", "case when c_custkey % 2 = 0 then concat('o', c_custkey % 60) end orcid", "concat('supplier#', lpad(c_custkey % 300, 9, '0')) name")
    return resolve.ladder(r, e, "rid", "eid", [("orcid", F.col("orcid"), F.col("orcid")), ("name", F.col("name"), F.col("name"))])


_ISSN = """v AS (SELECT c_custkey AS id, right('0000' || (c_custkey % 900), 4) || '-' || right('0000' || (c_custkey % 7), 4) AS issn,
  CASE WHEN c_custkey % 3 = 0 THEN right('0000' || (c_custkey % 90), 4) || right('0000' || (c_custkey % 7), 4) END AS eissn FROM customer)"""


def _issn_venues(spark, sf_dir):
    four = "lpad(cast({} as string), 4, '0')"
    a, b, c = (four.format(f"c_custkey % {n}") for n in (900, 7, 90))
    return table(spark, sf_dir, "customer").selectExpr("c_custkey id", f"concat({a}, '-', {b}) issn", f"case when c_custkey % 3 = 0 then concat({c}, {b}) end eissn")


@query(
    "j23_issn_match",
    f"""WITH {_ISSN}, k AS (SELECT key, min(id) AS id FROM (SELECT replace(issn, '-', '') AS key, id FROM v UNION ALL SELECT eissn, id FROM v) WHERE key <> '' GROUP BY 1),
    m AS (SELECT p_partkey AS rid, right('0000' || (p_partkey % 80), 4) || right('0000' || (p_partkey % 7), 4) AS key FROM part)
    SELECT rid, k.id AS venue_id FROM m JOIN k USING (key)""",
)
def j23_issn_match(spark, sf_dir):
    r = table(spark, sf_dir, "part").selectExpr("p_partkey rid", "concat(lpad(cast(p_partkey % 80 as string), 4, '0'), '-', lpad(cast(p_partkey % 7 as string), 4, '0')) issn")
    return resolve.issn_match(r, "rid", [F.col("issn")], _issn_venues(spark, sf_dir))


@query(
    "m18_duplicate_issns",
    f"""WITH {_ISSN}, k AS (SELECT DISTINCT key, id FROM (SELECT issn AS key, id FROM v UNION ALL SELECT eissn, id FROM v) WHERE key IS NOT NULL),
    g AS (SELECT key, min(id) AS c FROM k GROUP BY 1) SELECT id AS duplicate, min(c) AS canonical FROM k JOIN g USING (key) WHERE id <> c GROUP BY 1""",
)
def m18_duplicate_issns(spark, sf_dir):
    return resolve.duplicate_issns(_issn_venues(spark, sf_dir))


@query(
    "f_identifiers",
    """SELECT o_orderkey AS id, '10.' || o_orderkey || '/abc' AS doi, CASE WHEN o_orderkey % 2 = 0 THEN right('0000000' || (o_orderkey % 10000000), 7) END AS issn7,
    'A' || o_orderkey AS tail, '10.' || o_orderkey || '_abc' AS stem, 'PMC' || o_orderkey AS pmcid, 'Q' || o_orderkey AS wikidata FROM orders""",
)
def f_identifiers(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    seven = F.lpad((F.col("o_orderkey") % 10000000).cast("string"), 7, "0")
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.left(seven, F.lit(4)), F.lit(" - "), F.right(seven, F.lit(3)), F.lit("x"))).otherwise(F.lit("1234-56"))
    found = ids.issn(raw)
    doi = ids.doi_at_load(F.concat(F.lit(" https://doi.org/10."), k, F.lit("/ ABC. ")))
    return o.select(
        F.col("o_orderkey").alias("id"), doi.alias("doi"), F.concat(F.left(found, F.lit(4)), F.substring(found, 6, 3)).alias("issn7"), ids.last_segment(F.concat(F.lit("https://openalex.org/A"), k, F.lit("/"))).alias("tail"),
        ids.file_stem(doi).alias("stem"), ids.pmcid(F.concat(F.lit("see pmc"), k)).alias("pmcid"), ids.wikidata_id(F.concat(F.lit("http://www.wikidata.org/entity/Q"), k)).alias("wikidata"),
    )


@query(
    "f_values",
    """SELECT o_orderkey AS id, CAST(o_orderkey AS DOUBLE) + 0.5 AS thousands, CAST(o_orderkey AS DOUBLE) + 0.25 AS comma, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS flag, 'en' AS lang,
    o_orderkey || '-' || (o_orderkey + 9) AS pages, round(least(1.0, ln(1 + o_orderkey % 60) / ln(51)), 6) AS confidence, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def f_values(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    s = k.cast("string")
    return o.select(
        k.alias("id"), values.decimal_thousands(F.concat(s, F.lit(",5"))).alias("thousands"), values.decimal_comma(F.concat(s, F.lit(",25"))).alias("comma"), values.flag(F.when(k % 2 == 0, "True").otherwise("no")).alias("flag"),
        values.language(F.lit("EN-us")).alias("lang"), values.pages_cleaned(F.concat(values.pages(s, (k + 9).cast("string")), F.lit(" pp."))).alias("pages"),
        values.rounded(values.confidence(k % 60), 6).alias("confidence"), values.date_of_parts(F.array(F.year(d), F.month(d), F.dayofmonth(d))).alias("day"),
    )


@query("f_page_text")
def f_page_text(spark, sf_dir):
    from ..ship import to_workers

    to_workers(spark)
    return table(spark, sf_dir, "pages").select("page_id", text.ingest_text(F.col("html")).alias("ingest"), text.cleaned_text(F.col("html")).alias("cleaned"))


from . import loading, loads, new_entities, registries, repairs, stored, venues_and_summaries, whole  # noqa: E402, F401  (register their queries)
