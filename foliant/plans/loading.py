"""Queries of the loading rules: titles, venues, authorships, un-merging, the transform; registered with those of `registry`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import places
from ..operators import titles, venues, works
from . import transform
from .adapters import Tables
from .registry import over, query, table


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(map(_quoted, values)) + ")"


_RECORDS = """rec AS (SELECT o_orderkey AS id,
  CASE o_orderkey % 13 WHEN 0 THEN 'Índice' WHEN 1 THEN 'Book Review: a life' WHEN 2 THEN 'A study of order ' || o_orderkey WHEN 3 THEN 'Editorial ' || o_orderkey
    WHEN 4 THEN 'Collected essays, 320 pp.' WHEN 5 THEN '  ' WHEN 6 THEN 'A. B. C. D' WHEN 7 THEN 'Erratum' WHEN 8 THEN 'Notes on Contributors' WHEN 9 THEN 'Prices from USD 29 onward'
    WHEN 10 THEN NULL WHEN 11 THEN 'Dissertações do ano' ELSE 'The presentation of self' END AS title,
  CASE o_orderkey % 5 WHEN 0 THEN 'Editorial' WHEN 1 THEN 'peer-review' WHEN 2 THEN NULL ELSE 'journal-article' END AS work_type,
  CASE o_orderkey % 7 WHEN 0 THEN 'By A. Author. Oxford University Press, 1998. 320 pp. $29.95' WHEN 1 THEN 'Routledge Press, 1998, 12 pp' WHEN 2 THEN 'a plain subtitle' END AS subtitle FROM orders)"""
_FILTERED = r"trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _records(spark, sf_dir):
    """The rows of _RECORDS; the SQL text is the same in both engines."""
    body = _RECORDS.split("(SELECT ", 1)[1].rsplit(" FROM ", 1)[0]
    return table(spark, sf_dir, "orders").selectExpr(*[x.strip() for x in body.replace("AS id,", "AS id\0").replace("AS title,", "AS title\0").replace("AS work_type,", "AS work_type\0").split("\0")])


def _exclusion_sql() -> str:
    cases = [f"WHEN k IN {_in(titles.EXCLUDED_TYPES)} THEN 'x:work_type=' || k", "WHEN t = '' THEN 'x:blank_title'", f"WHEN t IN {_in(titles.EXCLUDED_TITLES)} THEN 'x:title_exact=' || t"]
    cases += [f"WHEN regexp_matches(t, {_quoted(p)}) THEN 'x:title_pattern={label}'" for label, p in titles.TITLE_PATTERNS]
    cases += [f"WHEN length(subtitle) > 40 AND regexp_matches(subtitle, {_quoted('(?i)' + p)}) THEN 'x:subtitle_pattern={label}'" for label, p in titles.SUBTITLE_PATTERNS]
    kind, name = (f"coalesce({_FILTERED.format(c)}, '')" for c in ("work_type", "title"))
    return f"WITH {_RECORDS}, f AS (SELECT *, {kind} AS k, {name} AS t FROM rec) SELECT id, CASE WHEN title IS NULL THEN 'x:missing-title' {' '.join(cases)} END AS reason FROM f"


@query("p1_exclusions", f"SELECT * FROM ({_exclusion_sql()}) WHERE reason IS NOT NULL")
def p1_exclusions(spark, sf_dir):
    _, rejected = titles.ingest(_records(spark, sf_dir), "x")
    return rejected.select("id", "reason")


def _junk_sql() -> str:
    t, bare = "strip_accents(lower(title))", "strip_accents(lower(trim(title)))"
    prefixes = " OR ".join(f"starts_with({t}, {_quoted(titles.fold(p))})" for p in titles.PREFIXES)
    marks = " OR ".join(f"title LIKE {_quoted(p)}" for p in titles.PUNCTUATION)
    shapes = " OR ".join(f"regexp_matches(title, {_quoted('(?i)' + p)})" for p in titles.STRUCTURE)
    return f"""WITH {_RECORDS} SELECT id, CASE WHEN trim(coalesce(title, '')) = '' OR {bare} IN {_in(map(titles.fold, titles.PLACEHOLDERS))} THEN 'placeholder' WHEN {marks} THEN 'punctuation'
      WHEN {bare} IN {_in(map(titles.fold, titles.BOILERPLATE))} THEN 'boilerplate' WHEN {prefixes} THEN 'prefix' WHEN {shapes} THEN 'structure' END AS rule FROM rec"""


@query("p4_junk_titles", _junk_sql())
def p4_junk_titles(spark, sf_dir):
    return _records(spark, sf_dir).select("id", titles.junk_title(F.col("title")).alias("rule"))


def _citation_sql() -> str:
    groups = [" AND ".join([f"regexp_matches(subtitle, {_quoted('(?i)' + p)})" for p in ps] + [f"octet_length(encode(subtitle)) > {n}"]) for ps, n in titles.CITATIONS]
    return f"WITH {_RECORDS} SELECT id, coalesce(({' OR '.join(f'({g})' for g in groups)}) AND id % 4 < 2, false) AS review FROM rec"


@query("p9_review_subtitles", _citation_sql())
def p9_review_subtitles(spark, sf_dir):
    kind = F.when(F.col("id") % 4 == 0, "ARTICLE").when(F.col("id") % 4 == 1, "CHAPTER").otherwise("BOOK")
    return _records(spark, sf_dir).select("id", titles.cites_a_review(F.col("subtitle"), kind).alias("review"))


@query(
    "p10_mode_gate",
    """WITH i AS (SELECT c_custkey AS rid, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 400 END AS key FROM customer), s AS (SELECT DISTINCT p_partkey AS key FROM part WHERE p_partkey % 3 = 0)
    SELECT 'new' AS mode, rid FROM i WHERE key IS NULL OR key NOT IN (SELECT key FROM s) UNION ALL SELECT 'update', rid FROM i WHERE key IS NULL OR key IN (SELECT key FROM s)""",
)
def p10_mode_gate(spark, sf_dir):
    i = table(spark, sf_dir, "customer").selectExpr("c_custkey rid", "case when c_custkey % 9 <> 0 then c_custkey % 400 end key")
    s = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").selectExpr("p_partkey key")
    new, update = (titles.mode_gate(i, s, "key", m).select(F.lit(m).alias("mode"), "rid") for m in ("new", "update"))
    return new.unionByName(update)


_VENUES = """ven AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 OR c_custkey % 20 = 0 THEN 'i' || (c_custkey % 170) END AS issn, CASE WHEN c_custkey % 3 = 0 THEN 'c' || (c_custkey % 7) END AS country_code,
  CASE WHEN c_custkey % 4 = 0 THEN 1 WHEN c_custkey % 4 = 1 THEN 0 END AS open_access, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 30 END AS h_index FROM customer)"""


def _venues(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey id", "case when c_custkey % 10 <> 0 or c_custkey % 20 = 0 then concat('i', c_custkey % 170) end issn", "case when c_custkey % 3 = 0 then concat('c', c_custkey % 7) end country_code",
        "case when c_custkey % 4 = 0 then 1 when c_custkey % 4 = 1 then 0 end open_access", "case when c_custkey % 2 = 0 then c_custkey % 30 end h_index",
    )


@query(
    "m17_merge_venues",
    f"""WITH {_VENUES}, p AS (SELECT id AS dup, id - id % 10 AS c FROM ven WHERE id % 10 IN (3, 7) AND id - id % 10 IN (SELECT id FROM ven)), s AS (SELECT * FROM ven WHERE id NOT IN (SELECT dup FROM p)),
    o AS (SELECT c, arg_min(issn, id) FILTER (WHERE issn IS NOT NULL) AS issn, arg_min(country_code, id) FILTER (WHERE country_code IS NOT NULL) AS cc, max(coalesce(open_access, 0)) AS oa FROM ven JOIN p ON id = dup GROUP BY 1),
    held AS (SELECT DISTINCT issn AS h FROM s WHERE issn IS NOT NULL), f AS (SELECT issn AS fi, min(c) AS fc FROM o GROUP BY 1)
    SELECT s.id, coalesce(s.issn, CASE WHEN h IS NULL AND fc = o.c THEN o.issn END) AS issn, coalesce(s.country_code, cc) AS country_code,
      CASE WHEN o.c IS NULL THEN open_access ELSE greatest(coalesce(open_access, 0), oa) END AS open_access, h_index
    FROM s LEFT JOIN o ON s.id = o.c LEFT JOIN held ON o.issn = h LEFT JOIN f ON o.issn = fi""",
)
def m17_merge_venues(spark, sf_dir):
    pairs = table(spark, sf_dir, "customer").where("c_custkey % 10 in (3, 7)").selectExpr("c_custkey duplicate", "c_custkey - c_custkey % 10 canonical")
    return venues.merge_venues(_venues(spark, sf_dir), pairs)


@query(
    "m25_scimago_policy",
    f"""WITH {_VENUES}, r AS (SELECT s_suppkey * 2 AS id, 'n' || s_suppkey AS issn, s_suppkey % 40 AS h, CASE WHEN s_suppkey % 3 = 0 THEN 1 END AS oa FROM supplier)
    SELECT v.id, coalesce(v.issn, r.issn) AS issn, country_code, coalesce(oa, open_access) AS open_access, greatest(h_index, h) AS h_index,
      CASE WHEN r.id IS NOT NULL THEN 1 END AS is_indexed_in_scopus, CASE WHEN r.id IS NOT NULL AND v.id % 4 <> 0 THEN 'VALIDATED' WHEN v.id % 4 = 0 THEN 'FAILED' ELSE 'PENDING' END AS validation_status,
      CASE WHEN r.id IS NOT NULL THEN 'now' END AS last_validated_at FROM ven v LEFT JOIN r ON v.id = r.id""",
)
def m25_scimago_policy(spark, sf_dir):
    v = _venues(spark, sf_dir).withColumns({"is_indexed_in_scopus": F.lit(None).cast("int"), "validation_status": F.when(F.col("id") % 4 == 0, "FAILED").otherwise("PENDING"), "last_validated_at": F.lit(None).cast("string")})
    r = table(spark, sf_dir, "supplier").selectExpr("s_suppkey * 2 id", "concat('n', s_suppkey) issn", "s_suppkey % 40 h_index", "case when s_suppkey % 3 = 0 then 1 end open_access")
    return venues.update_scimago(v, r, F.lit("now"))


@query(
    "m26_publishers",
    """WITH o AS (SELECT s_suppkey AS id, 'House ' || (s_suppkey % 50) AS name FROM supplier), w AS (SELECT DISTINCT 'house ' || (p_partkey % 80) AS name FROM part),
    h AS (SELECT lower(name) AS k, min(id) AS id FROM o GROUP BY 1)
    SELECT name, CASE WHEN id IS NULL THEN (SELECT max(id) FROM o) + row_number() OVER (PARTITION BY id IS NULL ORDER BY name) ELSE id END AS publisher_id FROM w LEFT JOIN h ON w.name = k""",
)
def m26_publishers(spark, sf_dir):
    o = table(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "concat('House ', s_suppkey % 50) name", "'FUNDER' type")
    return venues.publishers(o, table(spark, sf_dir, "part").selectExpr("concat('house ', p_partkey % 80) name"))[1]


_ROLES = """cur AS (SELECT l_orderkey AS work_id, l_suppkey AS person_id, CASE l_returnflag WHEN 'A' THEN 'AUTHOR' WHEN 'R' THEN 'REVIEWER' ELSE 'EDITOR' END AS role, min(l_linenumber) AS position FROM lineitem GROUP BY 1, 2, 3),
  des AS (SELECT l_orderkey AS work_id, CASE WHEN l_linenumber % 4 = 0 THEN l_suppkey + 1 ELSE l_suppkey END AS person_id, CASE WHEN l_linenumber % 2 = 1 THEN 'EDITOR' WHEN l_returnflag = 'A' THEN 'AUTHOR' WHEN l_returnflag = 'R' THEN 'REVIEWER' ELSE 'EDITOR' END AS role, min(l_linenumber % 3 + 1) AS position
    FROM lineitem WHERE l_linenumber <> 5 GROUP BY 1, 2, 3)"""


@query(
    "m9_authorship_actions",
    f"""WITH {_ROLES}, a AS (SELECT work_id, person_id, min(role) AS r0 FROM cur GROUP BY 1, 2 HAVING count(*) = 1), b AS (SELECT work_id, person_id, min(role) AS r1 FROM des GROUP BY 1, 2 HAVING count(*) = 1),
    m AS (SELECT * FROM a JOIN b USING (work_id, person_id) WHERE r0 <> r1)
    SELECT 'reclassify' AS action, work_id, person_id, r1 AS role, r0 AS from_role FROM m
    UNION ALL SELECT 'insert', work_id, person_id, role, NULL FROM des d WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.work_id = d.work_id AND m.person_id = d.person_id)
      AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.work_id = d.work_id AND c.person_id = d.person_id AND c.role = d.role)
    UNION ALL SELECT 'update', work_id, person_id, role, NULL FROM des d JOIN cur c USING (work_id, person_id, role) WHERE d.position <> c.position""",
)
def m9_authorship_actions(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    none = {"affiliation_id": F.lit(None).cast("long"), "is_corresponding": F.lit(None).cast("int")}
    held = F.when(F.col("l_returnflag") == "A", "AUTHOR").when(F.col("l_returnflag") == "R", "REVIEWER").otherwise("EDITOR")
    cur = line.groupBy(F.col("l_orderkey").alias("work_id"), F.col("l_suppkey").alias("person_id"), held.alias("role")).agg(F.min("l_linenumber").alias("position"))
    who = F.when(F.col("l_linenumber") % 4 == 0, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey"))
    # Wanted roles come as the payload spells them; those that are none of the four count for nothing.
    role = F.when(F.col("l_linenumber") == 5, "chair").otherwise(F.when(F.col("l_linenumber") % 2 == 0, F.initcap(held)).otherwise(" editor "))
    des = line.select(F.col("l_orderkey").alias("work_id"), who.alias("person_id"), role.alias("role"), (F.col("l_linenumber") % 3 + 1).alias("position"))
    return works.reconcile_authorships(cur.withColumns(none), des.withColumns(none))[1]


@over(
    "m28_unmerge",
    """, e AS (SELECT id, work_id, row_number() OVER (PARTITION BY work_id ORDER BY id) AS n FROM pubs),
    c AS (SELECT id, (SELECT max(id) FROM works) + row_number() OVER (ORDER BY id) AS clone FROM e WHERE n > 1)
    SELECT p.id, coalesce(clone, p.work_id) AS work_id, k.authors FROM pubs p LEFT JOIN c USING (id) JOIN (SELECT work_id, count(*) AS authors FROM auths GROUP BY 1) k ON k.work_id = p.work_id""",
)
def m28_unmerge(spark, sf_dir):
    t = Tables(spark, sf_dir)
    _, pubs, children = works.unmerge(t.works, t.publications, t.works.select(F.col("id").alias("work_id")), {"authorships": t.authorships})
    return pubs.select("id", "work_id").join(children["authorships"].groupBy("work_id").agg(F.count(F.lit(1)).alias("authors")), "work_id")


@query(
    "f51_country_codes",
    """SELECT n_nationkey AS id, CASE upper(n_name) WHEN 'UNITED STATES' THEN 'US' WHEN 'UNITED KINGDOM' THEN 'GB' WHEN 'IRAN' THEN 'IR' WHEN 'VIETNAM' THEN 'VN'
    ELSE CASE WHEN n_nationkey % 2 = 0 THEN left(n_name, 2) END END AS country_code FROM nation""",
)
def f51_country_codes(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    codes = n.where("n_nationkey % 2 = 0").selectExpr("n_name name", "left(n_name, 2) code")
    return places.country_codes(n.selectExpr("n_nationkey id", "n_name"), "n_name", codes).select("id", "country_code")


@over(
    "c1_transform",
    """, h AS (SELECT a.person_id, citation_count, row_number() OVER (PARTITION BY a.person_id ORDER BY citation_count DESC) AS rn FROM auths a JOIN works w ON a.work_id = w.id)
    SELECT s.id AS person_id, preferred_name, x.total_works, y.h_index FROM persons s JOIN (SELECT person_id, count(DISTINCT work_id) AS total_works FROM auths GROUP BY 1) x ON s.id = x.person_id
    LEFT JOIN (SELECT person_id, CAST(max(CASE WHEN citation_count >= rn THEN rn ELSE 0 END) AS BIGINT) AS h_index FROM h GROUP BY 1) y ON s.id = y.person_id""",
)
def c1_transform(spark, sf_dir):
    t = Tables(spark, sf_dir)
    catalog = {n: getattr(t, n) for n in ("works", "publications", "authorships", "references", "venues", "persons", "subjects", "tiers", "venue_subjects")}
    return transform.run(catalog, F.lit("now"), 1998)["summary_persons"].select("person_id", "preferred_name", "total_works", "h_index")
