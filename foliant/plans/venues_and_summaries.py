"""Queries of venue records, conflicts and merges, the references' repair, and the summaries; registered with those of `registry`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import citations, cleanup, metrics, resolve, summaries, venues, works
from ..operators.keys import skip_on_conflict
from ..sources.records import SCOPUS
from . import load_venues, transform
from .adapters import Tables
from .registry import over, query, table
from .stored import cases, rows, rows_sql

_ENTRY = """named_struct('entry', named_struct('dc:title', concat(' Journal ', k, ' '), 'dc:publisher', concat('House ', k % 9), 'prism:aggregationType', element_at(array('Journal', 'Trade Journal', 'BookSeries'), cast(k % 3 + 1 as int)),
  'prism:issn', concat(lpad(k % 10000, 4, '0'), '0007'), 'prism:eIssn', case when k % 2 = 0 then 'bad' end, 'prism:url', case when k % 4 = 0 then concat('http://u/', k) end, 'source-id', cast(k as string), 'openaccess', cast(k % 2 as string), 'openaccessArticle', case when k % 2 = 0 then 'true' end,
  'link', array(named_struct('@ref', 'scopus-source', '@href', 'http://s'), named_struct('@ref', 'homepage', '@href', case when k % 3 = 0 then 'http://h' else ' ' end)), 'subject-area', array(named_struct('$', 'A', '@code', '1')),
  'SJRList', named_struct('SJR', array(named_struct('$', '1,25'))), 'SNIPList', named_struct('SNIP', array(named_struct('$', 'x'))), 'citeScoreYearInfoList', named_struct('citeScoreCurrentMetric', '0.0', 'citeScoreTracker', cast(k as string))))"""


def _scopus(spark, sf_dir):
    entry = SCOPUS.split("entry:array<", 1)[1].rsplit(">>", 1)[0]
    r = F.from_json(F.to_json(F.expr(_ENTRY)), f"entry {entry}")
    return table(spark, sf_dir, "customer").selectExpr("c_custkey k").select(r["entry"].alias("entry"), F.concat(F.lit("/x/"), F.col("k").cast("string"), F.lit(".json")).alias("path"))


@query(
    "m23_scopus_entries",
    """SELECT c_custkey AS fallback_id, 'Journal ' || c_custkey AS name, 'House ' || (c_custkey % 9) AS publisher, CASE c_custkey % 3 WHEN 0 THEN 'JOURNAL' WHEN 1 THEN 'OTHER' ELSE 'BOOK_SERIES' END AS type,
    CASE c_custkey % 3 WHEN 0 THEN 'journal' WHEN 1 THEN 'trade journal' ELSE 'bookseries' END AS aggregation_type, '' || c_custkey AS scopus_id, right('000' || (c_custkey % 10000), 4) || '-0007' AS issn,
    CASE WHEN c_custkey % 4 = 0 THEN 'http://u/' || c_custkey WHEN c_custkey % 3 = 0 THEN 'http://h' ELSE 'http://s' END AS homepage_url, CAST(c_custkey % 2 AS INTEGER) AS open_access, CASE WHEN c_custkey % 2 = 0 THEN 1 END AS is_in_doaj,
    CAST(c_custkey AS DOUBLE) AS citescore, 1.25::DOUBLE AS sjr FROM customer""",
)
def m23_scopus_entries(spark, sf_dir):
    found = venues.scopus_entries(_scopus(spark, sf_dir))
    return found.select("fallback_id", "name", "publisher", "type", "aggregation_type", "scopus_id", "issn", "homepage_url", "open_access", "is_in_doaj", "citescore", "sjr")


_HELD = {
    "id": "c_custkey", "name": "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE 'Own ' || c_custkey END", "type": "'OTHER'", "issn": "CASE WHEN c_custkey % 2 = 0 THEN '9999-0000' END", "sjr": "CAST(9 AS DOUBLE)",
    "citescore": "CAST(NULL AS DOUBLE)", "open_access": "0", "validation_status": "'FAILED'", "last_validated_at": "CAST(NULL AS STRING)", "aggregation_type": "CAST(NULL AS STRING)",
}


@query(
    "m23_scopus_update",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 1 AND c_custkey % 5 <> 0 THEN 'Own ' || c_custkey WHEN c_custkey % 2 = 1 THEN ' ' WHEN c_custkey % 5 = 0 THEN 'Journal ' || c_custkey ELSE 'Own ' || c_custkey END AS name,
    CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'JOURNAL' WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 2 THEN 'BOOK_SERIES' ELSE 'OTHER' END AS type, CASE WHEN c_custkey % 2 = 0 THEN '9999-0000' END AS issn,
    CAST(CASE WHEN c_custkey % 2 = 0 THEN 1.25 ELSE 9 END AS DOUBLE) AS sjr, CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS DOUBLE) AS citescore, CASE WHEN c_custkey % 2 = 0 THEN 'VALIDATED' ELSE 'FAILED' END AS validation_status,
    CASE WHEN c_custkey % 2 = 0 THEN 'now' END AS last_validated_at FROM customer""",
)
def m23_scopus_update(spark, sf_dir):
    """Every second venue is named by an entry."""
    said = venues.scopus_entries(_scopus(spark, sf_dir)).withColumn("id", F.col("fallback_id")).where("id % 2 = 0")
    out = venues.update_scopus(rows(spark, sf_dir, "customer", _HELD), said, F.lit("now"))
    return out.select("id", "name", "type", "issn", "sjr", "citescore", "validation_status", "last_validated_at")


@query(
    "j38_venue_conflicts",
    """WITH v AS (SELECT c_custkey AS id, 'i' || (c_custkey % 900) AS issn, CASE WHEN c_custkey % 4 = 0 THEN 'I' || (c_custkey % 700) END AS eissn, 'N' || (c_custkey % 800) AS name, c_mktsegment AS t FROM customer),
    k AS (SELECT DISTINCT * FROM (SELECT id, 'identifier' AS field, lower(issn) AS value FROM v UNION ALL SELECT id, 'identifier', lower(eissn) FROM v UNION ALL SELECT id, 'name', lower(name) || chr(31) || t FROM v) WHERE value IS NOT NULL)
    SELECT field, value, id AS duplicate, c AS canonical FROM (SELECT *, min(id) OVER (PARTITION BY field, value) AS c FROM k) WHERE id <> c""",
)
def j38_venue_conflicts(spark, sf_dir):
    v = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "concat('i', c_custkey % 900) issn", "case when c_custkey % 4 = 0 then concat('I', c_custkey % 700) end eissn", "concat('N', c_custkey % 800) name", "c_mktsegment type")
    return venues.conflicts(v)


@query(
    "m19_merge_by_map",
    """WITH v AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN right('000' || (c_custkey % 90), 4) || '-0001' END AS issn FROM customer), m AS (SELECT c_custkey AS w, right('000' || (c_custkey % 120), 4) || '-0001' AS key FROM customer WHERE c_custkey % 3 = 1),
    h AS (SELECT issn AS key, min(id) AS c FROM v WHERE issn IS NOT NULL GROUP BY 1), f AS (SELECT key, (SELECT max(id) FROM v) + row_number() OVER (ORDER BY key) AS c FROM (SELECT DISTINCT key FROM m WHERE key NOT IN (SELECT key FROM h)))
    SELECT id, issn FROM v WHERE id NOT IN (SELECT w FROM m) UNION ALL SELECT c, key FROM f""",
)
def m19_merge_by_map(spark, sf_dir):
    four = "concat(lpad(cast({} as string), 4, '0'), '-0001')"
    v = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "concat('N', c_custkey) name", "'JOURNAL' type", f"case when c_custkey % 3 = 0 then {four.format('c_custkey % 90')} end issn", "cast(null as string) eissn")
    pairs = table(spark, sf_dir, "customer").where("c_custkey % 3 = 1").selectExpr("cast(c_custkey as string) wrong_id", f"replace({four.format('c_custkey % 120')}, '-', '') issn")
    return venues.merge_by_map(v, pairs)[0].select("id", "issn")


@query(
    "m40_category_links",
    """
    WITH s AS (SELECT p_partkey AS id, 'cat ' || p_partkey AS key FROM part),
    r AS (SELECT c_custkey AS venue_id, 'cat ' || (2 * c_custkey) AS key, CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN NULL ELSE 0.25 END AS score FROM customer),
    n AS (SELECT key, (SELECT max(id) FROM s) + row_number() OVER (ORDER BY key) AS id FROM (SELECT DISTINCT key FROM r WHERE key NOT IN (SELECT key FROM s))),
    l AS (SELECT venue_id, id AS subject_id, score FROM r JOIN (SELECT key, id FROM s UNION ALL SELECT key, id FROM n) USING (key)),
    e AS (SELECT c_custkey AS venue_id, 2 * c_custkey AS subject_id, 0.6 AS score FROM customer WHERE c_custkey % 2 = 0 AND 2 * c_custkey IN (SELECT id FROM s))
    SELECT coalesce(l.venue_id, e.venue_id) AS venue_id, coalesce(l.subject_id, e.subject_id) AS subject_id,
           CAST(CASE WHEN e.venue_id IS NOT NULL THEN greatest(0.6, coalesce(l.score, 0)) ELSE l.score END AS DOUBLE) AS score, 'scimago' AS source
    FROM l LEFT JOIN e ON l.venue_id = e.venue_id AND l.subject_id = e.subject_id
    """,
)
def m40_category_links(spark, sf_dir):
    """Each venue names its category twice, once with the better quartile; every part is a stored subject, and half the categories or so are new."""
    part = table(spark, sf_dir, "part")
    subjects = part.selectExpr(
        "p_partkey id", "concat('Cat ', p_partkey) term", "case when p_partkey % 30 < 10 then 'SCImago' else 'Scopus' end vocabulary", "case when p_partkey % 30 < 10 then 'Category' else 'SubjectArea' end subject_type", "'en' lang",
        "cast(null as string) external_uri", "cast(null as bigint) parent_id", "concat('cat ', p_partkey) term_key",
    )
    c = table(spark, sf_dir, "customer")
    better = "case c_custkey % 4 when 0 then ' (Q1)' when 1 then ' (Q3)' when 2 then '' else ' (Q4)' end"
    said = c.selectExpr("c_custkey venue_id", f"concat('Cat ', 2 * c_custkey, {better}, '; cat-', 2 * c_custkey, case when c_custkey % 4 = 0 then ' (Q2)' else '' end) categories")
    stored = c.where("c_custkey % 2 = 0").selectExpr("c_custkey venue_id", "2 * c_custkey subject_id", "0.6d score", "'old' source")
    stored = stored.join(part.select(F.col("p_partkey").alias("subject_id")), "subject_id", "left_semi").select("venue_id", "subject_id", "score", "source")
    return venues.link_categories(stored, subjects, said)[0]


@over("r6_dry_run", """, k AS (SELECT lower(doi) AS d, min(work_id) AS w FROM pubs GROUP BY 1)
    SELECT citing_work_id, n, CASE WHEN w IS NULL THEN 'PENDING' WHEN status = 'PENDING' OR cited_work_id IS DISTINCT FROM w THEN 'RESOLVED' ELSE status END AS status, w AS cited_work_id FROM refs LEFT JOIN k ON lower(cited_doi) = k.d
    WHERE status <> CASE WHEN w IS NULL THEN 'PENDING' ELSE 'RESOLVED' END OR cited_work_id IS DISTINCT FROM w""")
def r6_dry_run(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return citations.inconsistent(t.references, t.publications).select("citing_work_id", "n", "status", "cited_work_id")


_EDGES = {"id": "o_orderkey", "citing_work_id": "o_orderkey", "cited_doi": "'10.1/' || (o_orderkey * 2)", "status": cases("o_orderkey", ["'PENDING'", "'RESOLVED'", "'PENDING'"]), "cited_work_id": "CAST(NULL AS BIGINT)", "resolved_at": "CAST(NULL AS STRING)"}


@query(
    "r8_resolve_some",
    f"""WITH e AS {rows_sql("orders", {k: v.replace("STRING", "VARCHAR") for k, v in _EDGES.items()})}, h AS (SELECT id FROM e WHERE status = 'PENDING' AND id * 2 IN (SELECT o_orderkey FROM orders) ORDER BY id LIMIT 200)
    SELECT id, CASE WHEN h.id IS NOT NULL THEN 'RESOLVED' ELSE status END AS status, CASE WHEN h.id IS NOT NULL THEN id * 2 END AS cited_work_id, CASE WHEN h.id IS NOT NULL THEN 'now' END AS resolved_at FROM e LEFT JOIN h USING (id)""",
)
def r8_resolve_some(spark, sf_dir):
    """The limit is the routine's own: how many references one call resolves."""
    pubs = table(spark, sf_dir, "orders").selectExpr("concat('10.1/', o_orderkey) doi", "o_orderkey work_id")
    return citations.resolve_pending(rows(spark, sf_dir, "orders", _EDGES), pubs, F.lit("now"), 200).select("id", "status", "cited_work_id", "resolved_at")


@query(
    "m27_merge_organizations",
    """SELECT 'organization' AS kind, s_suppkey AS a, CASE WHEN s_suppkey % 2 = 0 THEN 'R' || s_suppkey WHEN s_suppkey = 3 THEN 'R4' END AS b FROM supplier WHERE s_suppkey <> 4
    UNION ALL SELECT 'authorship', l_orderkey, CAST(CASE WHEN l_suppkey % 10 = 4 THEN 3 ELSE l_suppkey % 10 END AS VARCHAR) FROM lineitem
    UNION ALL SELECT DISTINCT 'funding', l_orderkey, CAST(CASE WHEN l_suppkey % 10 = 4 THEN 3 ELSE l_suppkey % 10 END AS VARCHAR) FROM lineitem""",
)
def m27_merge_organizations(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    catalog = {
        "organizations": table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "case when s_suppkey % 2 = 0 then concat('R', s_suppkey) end ror_id"),
        "authorships": line.selectExpr("l_orderkey work_id", "l_suppkey % 10 affiliation_id"), "funding": line.selectExpr("l_orderkey work_id", "l_suppkey % 10 funder_id").distinct(),
    }
    out = resolve.merge_organizations(catalog, 3, 4)
    a = out["organizations"].selectExpr("'organization' kind", "id a", "ror_id b")
    return a.unionByName(out["authorships"].selectExpr("'authorship' kind", "work_id a", "cast(affiliation_id as string) b")).unionByName(out["funding"].selectExpr("'funding' kind", "work_id a", "cast(funder_id as string) b"))


@over(
    "j5_written_back",
    """, s AS (SELECT a.person_id, count(DISTINCT a.work_id) AS n, min(year) AS y FROM auths a LEFT JOIN pubs p ON a.work_id = p.work_id WHERE person_id % 3 = 0 GROUP BY 1)
    SELECT id, CASE WHEN s.person_id IS NOT NULL THEN n ELSE -1 END AS total_works, CAST(CASE WHEN s.person_id IS NOT NULL THEN y ELSE -1 END AS BIGINT) AS first_publication_year FROM persons LEFT JOIN s ON id = s.person_id""",
)
def j5_written_back(spark, sf_dir):
    """Persons that the statistics don't list keep their old numbers."""
    t = Tables(spark, sf_dir)
    stats = metrics.person_stats(t.authorships.where("person_id % 3 = 0"), t.publications)
    old = t.persons.selectExpr("id", "-1L total_works", "-1L first_publication_year")
    out = metrics.write_back(old, stats, "person_id", {"total_works": "total_works", "first_publication_year": "first_year"})
    return out.select("id", "total_works", F.col("first_publication_year").cast("long").alias("first_publication_year"))


@over(
    "r22_authors_json",
    """SELECT w.id AS work_id, a.search AS authors_search, a.js AS authors_json, '[{"id":' || w.id || ',"term":"' || work_type || '"}]' AS subjects_json FROM works w JOIN pubs p ON p.work_id = w.id LEFT JOIN (
      SELECT work_id, string_agg(role, ' ' ORDER BY position, role) AS search, '[' || string_agg('{"id":' || person_id || ',"name":"' || role || '","role":' || CASE WHEN role = 'N' THEN 'null' ELSE '"x"' END || '}', ',' ORDER BY person_id, role) || ']' AS js FROM auths GROUP BY 1) a ON a.work_id = w.id""",
)
def r22_authors_json(spark, sf_dir):
    t = Tables(spark, sf_dir)
    authors = t.authorships.select("work_id", F.col("person_id").alias("id"), F.col("role").alias("name"), F.when(F.col("role") != "N", "x").alias("role"), "position")
    subjects = t.works.selectExpr("id work_id", "id", "work_type name")
    return summaries.publications(t.works, t.publications, t.venues, authors, subjects).select("work_id", "authors_search", "authors_json", "subjects_json")


@over(
    "r23_summary_persons",
    """, o AS (SELECT p_partkey AS id, p_brand AS name, p_type AS type FROM part)
    SELECT s.id AS person_id, n.names AS affiliations_search, j.js AS current_affiliations_json FROM persons s LEFT JOIN (SELECT person_id, string_agg(name, ' ' ORDER BY name) AS names FROM (SELECT DISTINCT person_id, name FROM auths JOIN o ON affiliation_id = o.id) GROUP BY 1) n ON n.person_id = s.id
    LEFT JOIN (SELECT person_id, '[' || string_agg('{"id":' || o.id || ',"name":"' || name || '","type":"' || type || '"}', ',' ORDER BY o.id) || ']' AS js FROM auths JOIN o ON affiliation_id = o.id GROUP BY 1) j ON j.person_id = s.id""",
)
def r23_summary_persons(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orgs = table(spark, sf_dir, "part").selectExpr("p_partkey id", "p_brand name", "p_type type")
    return summaries.persons(t.persons.select("id"), t.authorships, orgs)


@over(
    "r24_summary_venues",
    """, t AS (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY score DESC NULLS LAST, subject_id) AS r FROM vsubs), j AS (SELECT venue_id, string_agg(subject_id || ':' || p_brand, ',' ORDER BY r) AS top, count(*) AS n FROM t JOIN part ON subject_id = p_partkey WHERE r <= 10 GROUP BY 1)
    SELECT v.id AS venue_id, s_name AS publisher_search, top, n FROM venues v LEFT JOIN supplier ON v.id % 50 = s_suppkey LEFT JOIN j ON j.venue_id = v.id""",
)
def r24_summary_venues(spark, sf_dir):
    """The JSON read back, as the engines write numbers differently."""
    t = Tables(spark, sf_dir)
    named = table(spark, sf_dir, "part").selectExpr("p_partkey id", "p_brand term")
    out = summaries.venues(t.venues.withColumn("publisher_id", F.col("id") % 50), table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "s_name name"), t.venue_subjects, named)
    top = F.from_json("top_subjects_json", "array<struct<id:bigint,term:string,score:double>>")
    joined = F.array_join(F.transform(top, lambda x: F.concat_ws(":", x["id"], x["term"])), ",")
    return out.select("venue_id", "publisher_search", F.when(top.isNotNull(), joined).alias("top"), F.when(top.isNotNull(), F.size(top)).cast("long").alias("n"))


@over(
    "c1_transform_tables",
    """, k AS (SELECT lower(doi) AS d, min(work_id) AS w FROM pubs GROUP BY 1), a AS (SELECT * FROM auths WHERE work_id IN (SELECT id FROM works) AND person_id IN (SELECT id FROM persons)), p AS (SELECT * FROM persons WHERE id IN (SELECT person_id FROM a))
    SELECT 'authorships' AS name, count(*) AS n, CAST(sum(work_id) AS BIGINT) AS total FROM a UNION ALL SELECT 'persons', count(*), CAST(sum(id) AS BIGINT) FROM p
    UNION ALL SELECT 'publications', count(*), CAST(sum(CASE WHEN q.open_access = 0 AND v.open_access = 1 THEN 1 ELSE q.open_access END) AS BIGINT) FROM pubs q LEFT JOIN venues v ON q.venue_id = v.id
    UNION ALL SELECT 'references', count(*), CAST(sum(w) AS BIGINT) FROM refs LEFT JOIN k ON lower(cited_doi) = d WHERE citing_work_id IN (SELECT id FROM works)
    UNION ALL SELECT 'signatures', count(DISTINCT preferred_name), CAST(count(DISTINCT preferred_name) * (count(DISTINCT preferred_name) + 1) / 2 AS BIGINT) FROM p
    UNION ALL SELECT 'venue works', count(*), CAST(sum(n) AS BIGINT) FROM (SELECT v.id, count(DISTINCT work_id) AS n FROM venues v LEFT JOIN pubs q ON q.venue_id = v.id GROUP BY 1)
    UNION ALL SELECT 'summary_publications', count(*), CAST(sum(work_id) AS BIGINT) FROM pubs UNION ALL SELECT 'summary_persons', count(*), CAST(sum(x) AS BIGINT) FROM (SELECT person_id, count(DISTINCT work_id) AS x FROM a GROUP BY 1)
    UNION ALL SELECT 'summary_venues', count(*), CAST(sum(id) AS BIGINT) FROM venues""",
)
def c1_transform_tables(spark, sf_dir):
    """A fingerprint of every table that the transform makes or changes."""
    t = Tables(spark, sf_dir)
    catalog = {n: getattr(t, n) for n in ("works", "publications", "authorships", "references", "venues", "persons", "subjects", "tiers", "venue_subjects")}
    c = transform.run(catalog, F.lit("now"), 1998)
    line = lambda name, df, x: df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(F.expr(x)).cast("long").alias("total"))
    parts = [line("authorships", c["authorships"], "work_id"), line("persons", c["persons"], "id"), line("publications", c["publications"], "open_access"), line("references", c["references"], "cited_work_id")]
    parts += [line("signatures", c["signatures"], "id"), line("venue works", c["venues"], "coalesce(works_count, 0)"), line("summary_publications", c["summary_publications"], "work_id")]
    parts += [line("summary_persons", c["summary_persons"], "total_works"), line("summary_venues", c["summary_venues"], "venue_id")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_RANKED = {
    "path": "'f.csv'", "Sourceid": "CAST(k AS STRING)", "Title": "CASE WHEN k % 3 = 0 THEN 'Stored ' || k ELSE 'New ' || (k % 40) END", "Type": "CASE WHEN k % 2 = 0 THEN 'Journal' ELSE 'Book Series' END",
    "Issn": "CASE WHEN k % 3 = 1 THEN lpad(CAST(k % 40 AS STRING), 4, '0') || '0003, bad' END", "Publisher": "'House ' || (k % 5)", "Country": "'Iran'", "Categories": "'Cat ' || (k % 4) || ' (Q1)'", "SJR": "'1.234,5'", "`H index`": "CAST(k % 9 AS STRING)", "`Open Access`": "'Yes'",
}


@query(
    "m41_scimago_load",
    """
    WITH r AS (SELECT c_custkey AS k FROM customer),
    v AS (SELECT k AS id, 'Stored ' || k AS name, 5 AS h FROM r WHERE k % 3 = 0),
    n AS (SELECT 'New ' || (k % 40) AS name, max(CASE WHEN k % 3 = 1 THEN right('000' || (k % 40), 4) || '-0003' END) AS issn FROM r WHERE k % 3 <> 0 GROUP BY 1)
    SELECT name, NULL AS issn, 1234.5::DOUBLE AS sjr, CAST(greatest(h, id % 9) AS BIGINT) AS h_index, 'VALIDATED' AS status,
           'House ' || (id % 5) AS publisher, 'IR' AS country, 'Cat ' || (id % 4) AS subject
    FROM v WHERE id % 2 = 0
    UNION ALL SELECT name, NULL, 9, h, 'PENDING', NULL, NULL, NULL FROM v WHERE id % 2 <> 0
    UNION ALL SELECT name, issn, 1234.5, NULL, 'VALIDATED', NULL, 'IR', NULL FROM n
    UNION ALL SELECT 'Stored ' || k, NULL, 1234.5, NULL, 'VALIDATED', NULL, 'IR', NULL FROM r WHERE k % 3 = 0 AND k % 2 <> 0
    """,
)
def m41_scimago_load(spark, sf_dir):
    """Stored venues are journals, so that rows of book series with their names make new ones. Rows of one new title and type are one
    venue, with or without ISSN; its other numbers come from several rows and are left out."""
    said = table(spark, sf_dir, "customer").selectExpr("c_custkey k").selectExpr(*[f"{x} AS {c}" for c, x in _RANKED.items()])
    schema = "id long, name string, type string, issn string, eissn string, scopus_id string, publisher_id long, country_code string, sjr double, open_access int, h_index long, is_indexed_in_scopus int, validation_status string, last_validated_at string"
    empty = spark.createDataFrame([], schema)
    held = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").selectExpr("c_custkey id", "concat('Stored ', c_custkey) name", "'JOURNAL' type", "9d sjr", "5L h_index", "'PENDING' validation_status")
    subjects = spark.createDataFrame([], "id long, term string, vocabulary string, subject_type string, lang string, external_uri string, parent_id long, term_key string")
    c = {
        "venues": empty.unionByName(held, allowMissingColumns=True), "organizations": spark.createDataFrame([], "id long, name string, type string"), "subjects": subjects,
        "venue_subjects": spark.createDataFrame([], "venue_id long, subject_id long, score double, source string"),
    }
    out, _ = load_venues.scimago(c, said, F.lit("now"))
    v = out["venues"].join(out["organizations"].select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher")), "publisher_id", "left")
    v = v.join(out["venue_subjects"].select(F.col("venue_id").alias("id"), "subject_id").join(out["subjects"].select(F.col("id").alias("subject_id"), F.col("term").alias("subject")), "subject_id"), "id", "left")
    old = F.col("h_index").isNotNull() & F.col("name").startswith("Stored") & (F.col("type") == "JOURNAL")
    shown = lambda c: F.when(old, F.col(c)).alias(c)
    return v.select("name", "issn", "sjr", shown("h_index"), F.col("validation_status").alias("status"), shown("publisher"), F.col("country_code").alias("country"), shown("subject")).distinct()


@over("l6_snapshot", """SELECT work_id, role, position, a.person_id, preferred_name, affiliation_id, is_corresponding FROM auths a LEFT JOIN persons ON a.person_id = id""")
def l6_snapshot(spark, sf_dir):
    t = Tables(spark, sf_dir)
    flag = F.when(F.col("is_corresponding") == 1, 1)
    return works.snapshot(t.authorships.withColumn("is_corresponding", flag), t.persons)


@query(
    "g22_column_stats",
    """WITH n AS (SELECT o_orderkey AS id, 'K' || (o_orderkey % 50) || CASE WHEN o_orderkey % 3 = 0 THEN '.' ELSE '' END AS old FROM orders), m AS (SELECT *, rtrim(old, '.') AS new FROM n), k AS (SELECT *, min(CASE WHEN old <> new THEN id END) OVER (PARTITION BY new) AS first, bool_or(old = new) OVER (PARTITION BY new) AS held FROM m)
    SELECT count(*) AS scanned, count(*) FILTER (WHERE old <> new) AS changed, count(*) FILTER (WHERE old <> new AND id = first AND NOT held) AS updated, count(*) FILTER (WHERE old <> new AND (id <> first OR held)) AS skipped_integrity, CAST(0 AS BIGINT) AS skipped_empty FROM k""",
)
def g22_column_stats(spark, sf_dir):
    before = table(spark, sf_dir, "orders").selectExpr("o_orderkey id", "concat('K', o_orderkey % 50, case when o_orderkey % 3 = 0 then '.' else '' end) k")
    new = F.regexp_replace("k", r"\.$", "")
    return cleanup.column_stats(before, new, skip_on_conflict(before, "k", new, "id"), "k")


@query("f34_abstracts", "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'the w' || o_orderkey || ' the  end' WHEN 1 THEN '  late' END AS abstract FROM orders")
def f34_abstracts(spark, sf_dir):
    index = F.expr("case o_orderkey % 3 when 0 then map('the', array(2, 0), concat('w', o_orderkey), array(1), 'end', array(4)) when 1 then map('early', array(2), 'late', array(2)) end")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), text.abstract_of_index(index).alias("abstract"))
