"""Queries of new records that are one entity by chains of keys; registered with those of `registry`.

The keys of an order are shared with its neighbours, each by another span, so that entities are chains of several lengths.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities
from . import load_venues
from .registry import query, table
from .stored import rows, rows_sql

_ORDERS = {"rid": "o_orderkey", "c": "o_custkey", "place": "o_orderkey"}


def _span(first: int, width: int) -> str:
    """The number of the span that an order falls in."""
    return f"cast(floor((place + {first}) / {width}) as bigint)"


def _components(keys: list[str]) -> str:
    """CTEs: root of each row of rest (rid and keys) over shared keys, by walking from key to key."""
    pairs = " UNION ALL ".join(f"SELECT rid, '{k}' || {k} AS key FROM rest WHERE {k} IS NOT NULL" for k in keys)
    return f"""pairs AS ({pairs}),
    steps AS (SELECT DISTINCT a.rid AS a, b.rid AS b FROM pairs a JOIN pairs b USING (key)),
    walk AS (SELECT rid, rid AS seen FROM rest UNION SELECT walk.rid, steps.b FROM walk JOIN steps ON walk.seen = steps.a),
    roots AS (SELECT rid, min(seen) AS root FROM walk GROUP BY rid)"""


def _first(column: str) -> str:
    return f"arg_min({column}, rid) FILTER (WHERE {column} IS NOT NULL)"


_ORGS = {
    "rid": "rid",
    "type": "'INSTITUTE'",
    "ror_id": f"CASE WHEN c % 3 = 0 THEN concat('ror', {_span(0, 8)}) END",
    "openalex_id": f"CASE WHEN c % 3 <> 1 THEN concat('I', {_span(4, 8)}) END",
    "name": f"CASE WHEN c % 4 <> 0 THEN concat('Org ', {_span(2, 6)}) END",
}


@query(
    "m15_chained_organizations",
    f"""
    WITH RECURSIVE rec AS (SELECT * FROM {rows_sql('orders', _ORDERS, _ORGS)}),
    st AS (SELECT s_suppkey AS id, 'Org ' || (s_suppkey * 40) AS name, 'ror' || (s_suppkey * 7) AS ror_id FROM supplier),
    m1 AS (
      SELECT rid, coalesce(r.id, n.id) AS id
      FROM rec LEFT JOIN (SELECT ror_id, min(id) AS id FROM st GROUP BY 1) r USING (ror_id)
               LEFT JOIN (SELECT name, min(id) AS id FROM st GROUP BY 1) n USING (name)),
    said AS (SELECT id, {_first('openalex_id')} AS openalex_id FROM m1 JOIN rec USING (rid) WHERE id IS NOT NULL GROUP BY id),
    took AS (SELECT openalex_id, min(id) AS id FROM said WHERE openalex_id IS NOT NULL GROUP BY 1),
    full_ AS (SELECT st.*, took.openalex_id FROM st LEFT JOIN took USING (id)),
    m2 AS (SELECT rid, took.id FROM m1 JOIN rec USING (rid) JOIN took USING (openalex_id) WHERE m1.id IS NULL),
    late AS (SELECT id, count(*) AS n FROM (SELECT * FROM m1 WHERE id IS NOT NULL UNION ALL SELECT * FROM m2) GROUP BY id),
    rest AS (
      SELECT *, coalesce('0:' || ror_id, '1:' || openalex_id, '4:' || lower(name) || chr(31) || type) AS first_key
      FROM rec WHERE rid IN (SELECT rid FROM m1 WHERE id IS NULL) AND rid NOT IN (SELECT rid FROM m2)),
    {_components(['ror_id', 'openalex_id', 'name'])},
    made AS (
      SELECT root, {_first('name')} AS name, {_first('ror_id')} AS ror_id, {_first('openalex_id')} AS openalex_id, min(first_key) AS first_key, count(*) AS n
      FROM rest JOIN roots USING (rid) WHERE first_key IS NOT NULL GROUP BY root HAVING count(name) > 0)
    SELECT id, name, ror_id, openalex_id, coalesce(n, 0) AS records FROM full_ LEFT JOIN late USING (id)
    UNION ALL
    SELECT (SELECT max(id) FROM st) + row_number() OVER (ORDER BY first_key), name, ror_id, openalex_id, n FROM made
    """,
)
def m15_chained_organizations(spark, sf_dir):
    """Organisations of records that share ROR numbers, OpenAlex numbers or names, one by one or in chains; some are stored."""
    stored = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey id", "concat('Org ', s_suppkey * 40) name", "'INSTITUTE' type", "cast(null as string) country_code",
        "concat('ror', s_suppkey * 7) ror_id", *[f"cast(null as string) {c}" for c in ("openalex_id", "wikidata_id", "mag_id", "url")],
    )
    out, links = entities.organizations(stored, rows(spark, sf_dir, "orders", _ORDERS, _ORGS))
    n = links.groupBy("id").agg(F.count(F.lit(1)).alias("records"))
    return out.join(n, "id", "left").select("id", "name", "ror_id", "openalex_id", F.coalesce("records", F.lit(0).cast("long")).alias("records"))


_PEOPLE = {
    "rid": "rid",
    "orcid": f"CASE WHEN c % 3 <> 0 THEN concat('0000-0001-', lpad(cast({_span(0, 5)} % 10000 as varchar(9)), 4, '0'), '-', lpad(cast(cast(floor({_span(0, 5)} / 10000) as bigint) as varchar(9)), 4, '0')) END",
    "family": f"CASE WHEN c % 4 <> 0 THEN concat('Family', {_span(3, 7)}) END",
    "given": "'Ana'",
    "display": "cast(null as varchar(9))",
}


@query(
    "m15_chained_persons",
    f"""
    WITH RECURSIVE rest AS (SELECT * FROM {rows_sql('orders', _ORDERS, _PEOPLE)} WHERE family IS NOT NULL),
    {_components(['orcid', 'family'])}
    SELECT {_first('family')} AS family_name, {_first('orcid')} AS orcid, count(*) AS records FROM rest JOIN roots USING (rid) GROUP BY root
    """,
)
def m15_chained_persons(spark, sf_dir):
    """Persons of records that share an ORCID or a name; one that has neither family nor display name is nobody."""
    people = rows(spark, sf_dir, "orders", _ORDERS, _PEOPLE).where("family is not null")
    stored = spark.createDataFrame([], "id long, preferred_name string, family_name string, given_names string, orcid string")
    out, links = entities.persons(stored, people)
    return out.join(links.groupBy("id").agg(F.count(F.lit(1)).alias("records")), "id").select("family_name", "orcid", "records")


def _issn(number: str) -> str:
    """An ISSN of the right shape, from a number below a hundred million."""
    digits = f"lpad(cast({number} as varchar(9)), 8, '0')"
    return f"concat(substr({digits}, 1, 4), '-', substr({digits}, 5, 4))"


#: The print ISSN of some orders is the electronic one of others.
_VENUES = {
    "rid": "rid",
    "type": "'JOURNAL'",
    "issn": f"CASE WHEN c % 3 = 0 THEN {_issn(_span(0, 6))} END",
    "eissn": f"CASE WHEN c % 3 <> 2 THEN {_issn(_span(3, 6))} END",
    "openalex_id": f"CASE WHEN c % 5 = 0 THEN concat('S', {_span(1, 9)}) END",
    "name": f"CASE WHEN c % 4 <> 0 THEN concat('Journal ', {_span(2, 4)}) END",
}


def _same_venues(also: str) -> str:
    """Components over both ISSNs in one space, names, and the number `also`."""
    return _components(["name", also]).replace(
        "pairs AS (", "pairs AS (SELECT rid, 'issn' || issn AS key FROM rest WHERE issn IS NOT NULL UNION ALL SELECT rid, 'issn' || eissn FROM rest WHERE eissn IS NOT NULL UNION ALL "
    )


@query(
    "j26_chained_venues",
    f"""
    WITH RECURSIVE rest AS (SELECT * FROM {rows_sql('orders', _ORDERS, _VENUES)}),
    {_same_venues('openalex_id')}
    SELECT {_first('name')} AS name, {_first('issn')} AS issn, {_first('eissn')} AS eissn, {_first('openalex_id')} AS openalex_id, count(*) AS records
    FROM rest JOIN roots USING (rid) GROUP BY root HAVING count(name) > 0
    """,
)
def j26_chained_venues(spark, sf_dir):
    """Venues of records that share an ISSN, whichever the column, an OpenAlex number or a name."""
    stored = spark.createDataFrame([], "id long, name string, type string, issn string, eissn string, openalex_id string")
    out, links = entities.venues(stored, rows(spark, sf_dir, "orders", _ORDERS, _VENUES))
    return out.join(links.groupBy("id").agg(F.count(F.lit(1)).alias("records")), "id").select("name", "issn", "eissn", "openalex_id", "records")


#: Rows of the ranking file; Issn lists both numbers.
_RANKED = {
    "rid": "rid",
    "Title": f"concat('Ranked ', {_span(2, 4)})",
    "Sourceid": f"CASE WHEN c % 3 <> 1 THEN cast(1000 + {_span(1, 5)} as varchar(9)) ELSE '' END",
    "Issn": f"CASE WHEN c % 4 = 0 THEN concat(replace({_issn(_span(0, 6))}, '-', ''), ', ', replace({_issn(_span(4, 6))}, '-', '')) ELSE '-' END",
}


@query(
    "j29_chained_scimago",
    f"""
    WITH RECURSIVE rest AS (
      SELECT rid, Title AS name, nullif(Sourceid, '') AS scopus_id,
             CASE WHEN Issn <> '-' THEN substr(Issn, 1, 4) || '-' || substr(Issn, 5, 4) END AS issn, CASE WHEN Issn <> '-' THEN substr(Issn, 11, 4) || '-' || substr(Issn, 15, 4) END AS eissn
      FROM {rows_sql('orders', _ORDERS, _RANKED)}),
    {_same_venues('scopus_id')}
    SELECT root, count(*) AS records, count(DISTINCT scopus_id) AS numbers FROM rest JOIN roots USING (rid) GROUP BY root
    """,
)
def j29_chained_scimago(spark, sf_dir):
    """Venues of a ranking whose rows share ISSNs, Scopus numbers or titles."""
    said = rows(spark, sf_dir, "orders", _ORDERS, _RANKED)
    said = said.selectExpr(
        "cast(rid as string) path", "rid", "Title", "Sourceid", "Issn", "'journal' Type", "'' Publisher", "'' Country", "'' Categories", "'1' SJR", "'1' `H index`", "'No' `Open Access`"
    )
    schema = "id long, name string, type string, issn string, eissn string, scopus_id string, publisher_id long, country_code string, sjr double, open_access int, h_index long"
    c = {
        "venues": spark.createDataFrame([], f"{schema}, is_indexed_in_scopus int, validation_status string, last_validated_at string"),
        "organizations": spark.createDataFrame([], "id long, name string, type string"),
        "subjects": spark.createDataFrame([], "id long, term string, vocabulary string, subject_type string, lang string, external_uri string, parent_id long, term_key string"),
        "venue_subjects": spark.createDataFrame([], "venue_id long, subject_id long, score double, source string"),
    }
    _, links = load_venues.scimago(c, said.drop("rid"), F.lit("now"))
    named = links.join(said.select(F.concat_ws("\x1f", "path", "Sourceid", "Title").alias("rid"), F.col("rid").alias("row"), F.nullif("Sourceid", F.lit("")).alias("number")), "rid")
    return named.groupBy("id").agg(F.min("row").alias("root"), F.count(F.lit(1)).alias("records"), F.count_distinct("number").alias("numbers")).drop("id")
