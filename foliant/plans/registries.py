"""Queries of venues as three registries load them: clashes, merges with their children, whole loads; registered with those of `registry`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import venues
from ..operators.venue_conflicts import settle
from ..sources.records import OPENALEX_VENUE, SCOPUS
from . import load_venues
from .new_entities import _issn
from .registry import query, table

_EMPTY = {
    "organizations": "id long, name string, type string",
    "subjects": "id long, term string, vocabulary string, subject_type string, lang string, external_uri string, parent_id long, term_key string",
    "venue_subjects": "venue_id long, subject_id long, score double, source string",
}
_VENUE = (
    "id long, name string, type string, issn string, eissn string, scopus_id string, wikidata_id string, openalex_id string, mag_id string, publisher_id long, country_code string, homepage_url string, "
    "aggregation_type string, open_access int, is_in_doaj int, is_indexed_in_scopus int, h_index int, i10_index int, `2yr_mean_citedness` double, citescore double, sjr double, snip double, "
    "validation_status string, last_validated_at string"
)


def _catalog(spark, held) -> load_venues.Catalog:
    """A catalog with these venues, other tables empty."""
    c = {name: spark.createDataFrame([], schema) for name, schema in _EMPTY.items()}
    return c | {"venues": spark.createDataFrame([], _VENUE).unionByName(held, allowMissingColumns=True)}


def _customers(spark, sf_dir, **columns: str):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey k").selectExpr(*[f"{x} AS {c}" for c, x in columns.items()])


# Groups of six venues. The first asks for the ISSN of the second; the third, for the second's name and type; the fourth and fifth, for one free
# number; the sixth of every other group, for a number of the first.
_HELD = {
    "id": "k",
    "name": "CASE WHEN k % 6 = 2 THEN concat('N', k - 1) ELSE concat('N', k) END",
    "type": "CASE WHEN k % 6 = 2 THEN 'OTHER' ELSE 'JOURNAL' END",
    "issn": f"CASE WHEN k % 6 = 1 THEN {_issn('k')} END",
    "wikidata_id": "CASE WHEN k % 6 = 1 THEN concat('Q', k) END",
    "mag_id": "CASE WHEN k % 6 = 0 THEN concat('m', k) END",
    "openalex_id": "CAST(NULL AS STRING)",
    "open_access": "CASE k % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 END",
}
_ASKED = {
    "rid": "k",
    "id": "k",
    "type": "CASE WHEN k % 6 = 2 THEN 'JOURNAL' END",
    "issn": f"CASE WHEN k % 6 = 0 THEN {_issn('k + 1')} END",
    "openalex_id": "CASE k % 6 WHEN 3 THEN concat('S', k) WHEN 4 THEN concat('S', k - 1) END",
    "mag_id": "CASE WHEN k % 12 = 11 THEN concat('m', k - 5) WHEN k % 12 = 5 THEN concat('x', k) END",
}


@query(
    "m21_conflicts",
    f"""
    WITH v AS (SELECT c_custkey AS k, c_custkey % 6 AS s, c_custkey - c_custkey % 6 AS b, c_custkey % 12 >= 6 AS odd FROM customer),
    whole AS (SELECT *, CASE WHEN s = 0 AND NOT odd OR s = 5 AND odd THEN b + 1 END AS swallowed FROM v)
    SELECT 'merged' AS mode, k AS id, 'N' || CASE WHEN s = 2 THEN k - 1 ELSE k END AS name, 'JOURNAL' AS type,
           CASE WHEN swallowed IS NOT NULL THEN {_issn('swallowed')} END AS issn,
           CASE WHEN s = 4 THEN 'S' || (k - 1) END AS openalex_id, 'Q' || swallowed AS wikidata_id,
           CASE WHEN swallowed IS NOT NULL THEN 'm' || b WHEN s = 5 THEN 'x' || k END AS mag_id,
           CASE WHEN swallowed IS NOT NULL THEN 1 WHEN s = 4 THEN 0 END AS open_access
    FROM whole WHERE s NOT IN (1, 3) AND NOT (s = 0 AND odd)
    UNION ALL
    SELECT 'kept', k, 'N' || CASE WHEN s = 2 THEN k - 1 ELSE k END, CASE WHEN s = 2 THEN 'OTHER' ELSE 'JOURNAL' END, CASE WHEN s = 1 THEN {_issn('k')} END,
           CASE WHEN s = 3 THEN 'S' || k END, CASE WHEN s = 1 THEN 'Q' || k END, CASE WHEN s = 0 THEN 'm' || k WHEN s = 5 AND NOT odd THEN 'x' || k END, CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 END
    FROM v
    UNION ALL
    SELECT 'lost', k, CASE s WHEN 0 THEN 'issn' WHEN 2 THEN 'name' WHEN 4 THEN 'openalex_id' ELSE 'mag_id' END,
           CASE s WHEN 0 THEN {_issn('k + 1')} WHEN 2 THEN 'n' || (k - 1) || chr(31) || 'JOURNAL' WHEN 4 THEN 's' || (k - 1) ELSE 'm' || (k - 5) END, NULL, NULL, NULL, NULL, NULL
    FROM v WHERE s IN (0, 2, 4) OR s = 5 AND odd
    UNION ALL
    SELECT 'into', k, NULL, '' || CASE WHEN s = 3 THEN k + 1 WHEN odd THEN b + 5 ELSE b END, NULL, NULL, NULL, NULL, NULL FROM v WHERE s IN (1, 3) OR s = 0 AND odd
    """,
)
def m21_conflicts(spark, sf_dir):
    """What venues hold after their records were settled with and without merging, what was lost, and what went into what."""
    held, asked = _customers(spark, sf_dir, **_HELD), _customers(spark, sf_dir, **_ASKED)
    policy = venues.POLICY["openalex"]
    shown = ["id", "name", "type", "issn", "openalex_id", "wikidata_id", "mag_id", "open_access"]
    out = None
    for mode, merging in (("merged", True), ("kept", False)):
        done = settle(held, asked, policy, merging)
        one = venues.apply_policy(done.venues, done.records, "id", policy).select(F.lit(mode).alias("mode"), *shown)
        out = one if out is None else out.unionByName(one)
        extra = done.merged.select(F.lit("into").alias("mode"), F.col("duplicate").alias("id"), F.col("canonical").cast("string").alias("type")) if merging else done.lost.select(F.lit("lost").alias("mode"), "id", F.col("field").alias("name"), F.col("value").alias("type"))
        out = out.unionByName(extra, allowMissingColumns=True)
    return out


@query(
    "m17_children",
    """
    WITH v AS (SELECT c_custkey AS id, c_custkey % 10 AS d FROM customer),
    p AS (SELECT id AS dup, id - d AS canonical FROM v WHERE d IN (3, 7, 9) AND id - d IN (SELECT id FROM v)),
    s AS (SELECT o_custkey AS venue_id, o_orderkey % 50 AS subject_id, CAST(max(o_orderkey) AS DOUBLE) AS score FROM orders GROUP BY 1, 2),
    m AS (SELECT coalesce(canonical, venue_id) AS venue_id, subject_id, arg_min(score, (canonical IS NOT NULL, score)) AS score FROM s LEFT JOIN p ON venue_id = dup GROUP BY 1, 2),
    w AS (SELECT coalesce(canonical, o_custkey) AS venue_id, count(*) AS works FROM orders LEFT JOIN p ON o_custkey = dup GROUP BY 1)
    SELECT id, coalesce(works, 0) AS works, coalesce(n, 0) AS subjects, coalesce(total, 0) AS total
    FROM v LEFT JOIN w ON id = w.venue_id LEFT JOIN (SELECT venue_id, count(*) AS n, sum(score) AS total FROM m GROUP BY 1) m ON id = m.venue_id
    WHERE id NOT IN (SELECT dup FROM p)
    """,
)
def m17_children(spark, sf_dir):
    """Venues merged by pairs, some onto venues that are merged themselves; publications and subjects move along, none is left behind."""
    ids = table(spark, sf_dir, "customer").selectExpr("c_custkey id", "concat('V', c_custkey) name", "'JOURNAL' type")
    pairs = ids.where("id % 10 in (3, 7, 9)").selectExpr("id duplicate", "case when id % 10 = 9 then id - 2 else id - id % 10 end canonical")
    orders = table(spark, sf_dir, "orders")
    links = orders.groupBy(F.col("o_custkey").alias("venue_id"), (F.col("o_orderkey") % 50).alias("subject_id")).agg(F.max("o_orderkey").cast("double").alias("score"))
    c = venues.merge_in({"venues": ids, "publications": orders.selectExpr("o_orderkey id", "o_custkey venue_id"), "venue_subjects": links.withColumn("source", F.lit("x"))}, pairs)
    works = c["publications"].groupBy(F.col("venue_id").alias("id")).agg(F.count(F.lit(1)).alias("works"))
    subjects = c["venue_subjects"].groupBy(F.col("venue_id").alias("id")).agg(F.count(F.lit(1)).alias("subjects"), F.sum("score").alias("total"))
    every = c["venues"].select("id").join(works, "id", "full").join(subjects, "id", "full")
    return every.select("id", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("works", "subjects")], F.coalesce("total", F.lit(0.0)).alias("total"))


#: Stored venues by what a record finds them by: an ISSN in either column, three numbers, name and type; every seventh is new.
_KNOWN = {
    "id": "k", "name": "concat('J', k)", "type": "CASE WHEN k % 7 = 5 THEN 'JOURNAL' ELSE 'OTHER' END", "issn": f"CASE WHEN k % 7 = 0 THEN {_issn('k')} END", "eissn": f"CASE WHEN k % 7 = 1 THEN {_issn('k')} END",
    "openalex_id": "CASE WHEN k % 7 = 2 THEN concat('S', k) END", "wikidata_id": "CASE WHEN k % 7 = 3 THEN concat('Q', k) END", "mag_id": "CASE WHEN k % 7 = 4 THEN concat('m', k) END",
    "aggregation_type": "CASE WHEN k % 3 = 0 THEN 'Book-Series' WHEN k % 3 = 1 THEN 'thing' END", "validation_status": "CASE WHEN k % 2 = 0 THEN 'PENDING' ELSE 'FAILED' END",
}
_NODE = "named_struct('id', concat('http://o/{0}', k % {1}), 'display_name', concat('{2} ', k % {1}))"
_OPENALEX = f"""named_struct('id', concat('https://openalex.org/S', k), 'display_name', CASE WHEN k % 7 = 5 THEN concat(' J', k, ' ') ELSE concat('R', k) END, 'type', 'journal',
  'issn_l', CASE k % 7 WHEN 0 THEN {_issn('k')} WHEN 1 THEN {_issn('k')} WHEN 6 THEN {_issn('k')} END,
  'issn', CASE WHEN k % 14 = 13 THEN array({_issn('k')}, {_issn('k - 7')}) END, 'host_organization_name', concat('House ', k % 5), 'is_oa', k % 2 = 0,
  'ids', named_struct('openalex', concat('https://openalex.org/S', k), 'wikidata', CASE WHEN k % 7 = 3 THEN concat('https://w/wiki/Q', k) END, 'mag', CASE WHEN k % 7 = 4 THEN concat('m', k) END),
  'summary_stats', named_struct('h_index', cast(k % 50 AS INT)),
  'topics', array(named_struct('id', concat('http://o/T', k % 20), 'display_name', concat('Topic ', k % 20), 'subfield', {_NODE.format('S', 10, 'Sub')}, 'field', {_NODE.format('F', 5, 'Field')}, 'domain', {_NODE.format('D', 1, 'Domain')})))"""


@query(
    "j27_openalex_venues",
    f"""
    WITH r AS (SELECT c_custkey AS k, c_custkey % 7 AS s, '/v/' || c_custkey AS path FROM customer),
    g AS (SELECT *, CASE WHEN s <> 6 THEN k WHEN k % 14 = 13 THEN k - 7 ELSE k END AS v FROM r),
    n AS (SELECT v, arg_min(k, path) AS a, arg_max(k, path) AS z, count(DISTINCT k % 20) AS topics, max(CASE WHEN k % 14 = 13 THEN k END) AS listed FROM g GROUP BY v)
    SELECT CASE WHEN v % 7 = 6 THEN 'R' || a ELSE 'J' || v END AS name,
           CASE WHEN v % 7 = 6 OR v % 3 = 2 THEN 'JOURNAL' WHEN v % 3 = 0 THEN 'BOOK_SERIES' WHEN v % 7 = 5 THEN 'JOURNAL' ELSE 'OTHER' END AS type,
           CASE WHEN v % 7 IN (0, 1) THEN {_issn('v')} WHEN v % 7 = 6 THEN {_issn('a')} END AS issn,
           CASE WHEN v % 7 = 1 THEN {_issn('v')} WHEN v % 7 = 6 AND listed IS NOT NULL THEN {_issn('listed - 7')} END AS eissn,
           'S' || a AS openalex_id, CASE WHEN v % 7 = 3 THEN 'Q' || v END AS wikidata_id, CASE WHEN v % 7 = 4 THEN 'm' || v END AS mag_id,
           'House ' || (a % 5) AS publisher, CAST(z % 2 = 0 AS INTEGER) AS open_access, CAST(a % 50 AS INTEGER) AS h_index,
           CASE WHEN v % 7 = 6 OR v % 2 = 0 THEN 'VALIDATED' ELSE 'FAILED' END AS status, topics
    FROM n
    """,
)
def j27_openalex_venues(spark, sf_dir):
    """A load of OpenAlex venues over stored ones, with the number of topics linked to each."""
    r = F.from_json(F.to_json(F.expr(_OPENALEX)), OPENALEX_VENUE.split(", _broken")[0])
    found = _customers(spark, sf_dir, k="k").select(r.alias("r"), F.concat(F.lit("/v/"), F.col("k").cast("string")).alias("path")).select("r.*", "path")
    c, _ = load_venues.openalex(_catalog(spark, _customers(spark, sf_dir, **_KNOWN).where("id % 7 <> 6")), found, F.lit("now"))
    topics = c["venue_subjects"].groupBy(F.col("venue_id").alias("id")).agg(F.count(F.lit(1)).alias("topics"))
    v = c["venues"].join(c["organizations"].select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher")), "publisher_id", "left").join(topics, "id", "left")
    return v.select("name", "type", "issn", "eissn", "openalex_id", "wikidata_id", "mag_id", "publisher", "open_access", "h_index", F.col("validation_status").alias("status"), "topics")


@query(
    "m11_venue_topics",
    """
    SELECT c_custkey AS venue_id, 'Topic ' || (c_custkey % 20) || ' < Sub ' || (c_custkey % 10) || ' < Field ' || (c_custkey % 5) || ' < Domain 0' AS topic,
           CASE WHEN c_custkey % 20 = 3 THEN 'found' ELSE 'made' END AS how
    FROM customer WHERE c_custkey % 7 <> 6
    """,
)
def m11_venue_topics(spark, sf_dir):
    """The topics that a load of OpenAlex venues links, with all that stands above them; one was stored without address and parent."""
    r = F.from_json(F.to_json(F.expr(_OPENALEX)), OPENALEX_VENUE.split(", _broken")[0])
    found = _customers(spark, sf_dir, k="k").where("k % 7 <> 6").select(r.alias("r"), F.concat(F.lit("/v/"), F.col("k").cast("string")).alias("path")).select("r.*", "path")
    c = _catalog(spark, _customers(spark, sf_dir, **_KNOWN).where("id % 7 <> 6"))
    known = spark.createDataFrame([(900, "Topic 3", "OpenAlex", "Topic", "en", None, None, "topic 3")], _EMPTY["subjects"])
    c, _ = load_venues.openalex(c | {"subjects": c["subjects"].unionByName(known)}, found, F.lit("now"))
    s = c["subjects"]
    up = s.select(F.col("id").alias("subject_id"), F.col("term").alias("t0"), F.col("parent_id").alias("p0"), F.when(F.col("id") == 900, "found").otherwise("made").alias("how"))
    for k in range(1, 4):
        up = up.join(s.select(F.col("id").alias(f"p{k - 1}"), F.col("term").alias(f"t{k}"), F.col("parent_id").alias(f"p{k}")), f"p{k - 1}")
    return c["venue_subjects"].join(up, "subject_id").select("venue_id", F.concat_ws(" < ", "t0", "t1", "t2", "t3").alias("topic"), "how")


#: Stored venues by what a title finds them by: ISSN, Scopus number, the file's own id; of two kinds only the status changes, and one is new.
_LISTED = {
    "id": "k", "name": "concat('J', k)", "type": "'OTHER'", "issn": f"CASE WHEN k % 6 IN (0, 3) THEN {_issn('k')} END", "scopus_id": "CASE WHEN k % 6 = 1 THEN cast(k AS STRING) END", "validation_status": "'PENDING'",
}
_SCOPUS = f"""named_struct('entry', named_struct('dc:title', concat('T', k), 'dc:publisher', concat('House ', k % 9), 'prism:aggregationType', 'Journal', 'prism:issn', CASE WHEN k % 6 IN (0, 5) THEN {_issn('k')} END,
  'source-id', CASE WHEN k % 6 IN (1, 5) THEN cast(k AS STRING) END, 'openaccess', '1', 'subject-area', array(named_struct('$', concat('Area ', k % 8), '@code', cast(k % 8 AS STRING)), named_struct('$', 'General', '@code', CAST(NULL AS STRING)))))"""


@query(
    "j28_scopus_load",
    f"""
    WITH v AS (SELECT c_custkey AS k, c_custkey % 6 AS s FROM customer)
    SELECT CASE WHEN s = 5 THEN 'T' ELSE 'J' END || k AS name, CASE WHEN s IN (3, 4) THEN 'OTHER' ELSE 'JOURNAL' END AS type, CASE WHEN s IN (0, 3, 5) THEN {_issn('k')} END AS issn,
           CASE WHEN s IN (1, 5) THEN '' || k END AS scopus_id, CASE WHEN s NOT IN (3, 4) THEN 'House ' || (k % 9) END AS publisher,
           CASE s WHEN 3 THEN 'NOT_FOUND' WHEN 4 THEN 'FAILED' ELSE 'VALIDATED' END AS status, 'now' AS as_of,
           CASE WHEN s NOT IN (3, 4) THEN 'Area ' || (k % 8) || ', General' END AS subjects, CASE WHEN s NOT IN (3, 4) THEN 'scopus' END AS source
    FROM v
    """,
)
def j28_scopus_load(spark, sf_dir):
    """A load of Scopus titles: entries by each rung, responses without entry that the request's ISSN or the file's name leads to a venue, subject areas."""
    entry = SCOPUS.split("entry:array<", 1)[1].rsplit(">>", 1)[0]
    r = F.from_json(F.to_json(F.expr(_SCOPUS)), f"entry {entry}")
    kind = F.col("k") % 6
    asked = F.array(F.lit("https://h/x?view=a"), F.concat(F.lit("https://h/serial?issn="), F.expr(_issn("k")), F.lit("&view=b")))
    titles = _customers(spark, sf_dir, k="k").select(
        F.when(~kind.isin(3, 4), r["entry"]).alias("entry"), F.when(kind == 3, " No Results Found").when(kind == 4, "quota exceeded").alias("error"), F.when(kind == 3, asked).alias("links"),
        F.concat(F.when(kind.isin(2, 4), "/x/").otherwise("/x/title-"), F.col("k").cast("string"), F.lit(".json")).alias("path"),
    )
    c, _ = load_venues.scopus(_catalog(spark, _customers(spark, sf_dir, **_LISTED).where("id % 6 <> 5")), titles, F.lit("now"))
    s = c["venue_subjects"].join(c["subjects"].select(F.col("id").alias("subject_id"), "term"), "subject_id").groupBy(F.col("venue_id").alias("id"))
    s = s.agg(F.array_join(F.array_sort(F.collect_list("term")), ", ").alias("subjects"), F.max("source").alias("source"))
    v = c["venues"].join(c["organizations"].select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher")), "publisher_id", "left").join(s, "id", "left")
    return v.select("name", "type", "issn", "scopus_id", "publisher", F.col("validation_status").alias("status"), F.col("last_validated_at").alias("as_of"), "subjects", "source")
