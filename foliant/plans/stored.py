"""Queries of names, parsers and the clean-up of stored tables; registered with those of `registry`.

Inputs are written once, as expressions that both engines read; what must come out is stated in SQL of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..functions import text, values
from ..operators import cleanup, persons, ranking, tiers
from .registry import query, table


def cases(by: str, choices: list[str]) -> str:
    """A CASE that gives the k-th choice where `by` leaves k."""
    return f"CASE {by} % {len(choices)} " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(choices)) + " END"


def rows(spark, sf_dir: str, name: str, *levels: dict[str, str]) -> DataFrame:
    """A table's rows through expressions, level by level."""
    df = table(spark, sf_dir, name)
    for level in levels:
        df = df.selectExpr(*[f"{x} AS {c}" for c, x in level.items()])
    return df


def rows_sql(name: str, *levels: dict[str, str]) -> str:
    for level in levels:
        name = f"(SELECT {', '.join(f'{x} AS {c}' for c, x in level.items())} FROM {name})"
    return name


_GIVEN = cases("c_custkey", ["'João'", "'Ana'", "'Éric'", "'Maria'", "'Zoë'"])
_FAMILY = "'Fam' || chr(cast(97 + c_custkey % 26 as int)) || chr(cast(97 + c_custkey % 7 as int))"
_PEOPLE = {"id": "c_custkey", "g": _GIVEN, "f": _FAMILY}
#: A name and its signature, by shape.
_SIGNED = [
    ("g || ' ' || f", "upper(f) || ' ' || left(upper(g), 1)"), ("g || ' de la ' || f", "'DE LA ' || upper(f) || ' ' || left(upper(g), 1)"),
    ("g || ' Paula ' || f || ' Neto'", "upper(f) || ' ' || left(upper(g), 1) || ' P'"), ("f", "upper(f)"), ("'X'", "NULL"),
    ("g || ' ' || f || '-Costa'", "upper(f) || '-COSTA ' || left(upper(g), 1)"), ("g || ' della ' || f", "'DELLA ' || upper(f) || ' ' || left(upper(g), 1)"),
    ("'De ' || f", "'DE ' || upper(f)"), ("g || ', ' || f || '.'", "upper(f) || ' ' || left(upper(g), 1)"), ("g || ' van der ' || f || ' III'", "'VAN DER ' || upper(f) || ' ' || left(upper(g), 1)"),
    ("'G. M. ' || f", "upper(f) || ' G M'"), ("' - ' || f || ' - '", "upper(f)"), ("g || ' ' || f || ' Bisneta'", "upper(f) || ' ' || left(upper(g), 1)"), ("NULL", "NULL"),
    ("g || ' d''' || f", "upper(f) || ' ' || left(upper(g), 1) || ' D'"), ("'Ana-Lu ' || g || ' dos ' || f", "'DOS ' || upper(f) || ' A ' || left(upper(g), 1)"),
]
#: A preferred name, its family name and its given names, by shape.
_SPLIT = [
    ("g || ' ' || f", "f", "g"), ("g || ' de la ' || f", "'de la ' || f", "g"), ("g || ' ' || f || ' Junior'", "f || ' Junior'", "g"), ("f", "f", "NULL"), ("NULL", "NULL", "NULL"),
    ("'  ' || g || ' van der ' || f || ' ' ", "'van der ' || f", "g"), ("'De ' || f", "'De ' || f", "NULL"), ("g || ' Eça Sá ' || f", "f", "g || ' Eça Sá'"), ("g || ' Mc ' || f || ' iii'", "'Mc ' || f || ' iii'", "g"),
]
#: Family, given and display name, and what comes of them: given, surname, preferred.
_PREPARED = [
    ("f", "g", "NULL", "g", "f", "g || ' ' || f"), ("f", "NULL", "NULL", "f", "f", "f || ' ' || f"), ("NULL", "NULL", "g || ' ' || f", "g", "f", "g || ' ' || f"),
    ("NULL", "NULL", "f || ', ' || g || ' M'", "g || ' M'", "f", "g || ' M ' || f"), ("f || ', ' || g", "NULL", "NULL", "g", "f", "g || ' ' || f"), ("''", "g", "f", "g", "g", "g || ' ' || g"),
    ("NULL", "NULL", "g", "g", "g", "g || ' ' || g"), ("f || '.'", "g || '; '", "NULL", "g", "f", "g || ' ' || f"), ("NULL", "NULL", "NULL", "NULL", "NULL", "NULL"),
    ("NULL", "''", "g || ' M. ' || f || ';'", "g || ' M'", "f", "g || ' M ' || f"), ("f", "g || ', Jr'", "NULL", "'Jr ' || f", "g", "'Jr ' || f || ' ' || g"), ("repeat(f, 60)", "repeat(g, 90)", "NULL", "left(repeat(g, 90), 255)", "left(repeat(f, 60), 100)", "left(repeat(g, 90) || ' ' || repeat(f, 60), 255)"),
]


def _shape(column: int, table_: list) -> str:
    return cases("id", [x[column] for x in table_])


@query("f46_signatures", f"SELECT id, {_shape(1, _SIGNED)} AS signature FROM {rows_sql('customer', _PEOPLE)}")
def f46_signatures(spark, sf_dir):
    named = rows(spark, sf_dir, "customer", _PEOPLE, {"id": "id", "name": _shape(0, _SIGNED)})
    return named.select("id", text.signature(F.col("name")).alias("signature"))


@query("f47_family_and_given", f"SELECT id, {_shape(1, _SPLIT)} AS family_name, {_shape(2, _SPLIT)} AS given_names FROM {rows_sql('customer', _PEOPLE)}")
def f47_family_and_given(spark, sf_dir):
    named = rows(spark, sf_dir, "customer", _PEOPLE, {"id": "id", "preferred_name": _shape(0, _SPLIT), "family_name": "'old'", "given_names": "NULL"})
    repaired = persons.repair_names(named.where("preferred_name is not null"))
    rest = named.where("preferred_name is null").selectExpr("id", "cast(null as string) family_name", "cast(null as string) given_names")
    return repaired.select("id", "family_name", "given_names").unionByName(rest)


@query("f23_person_names", f"SELECT id, {_shape(3, _PREPARED)} AS given, {_shape(4, _PREPARED)} AS surname, {_shape(5, _PREPARED)} AS preferred FROM {rows_sql('customer', _PEOPLE)}")
def f23_person_names(spark, sf_dir):
    parts = rows(spark, sf_dir, "customer", _PEOPLE, {"id": "id", "family": _shape(0, _PREPARED), "given": _shape(1, _PREPARED), "display": _shape(2, _PREPARED)})
    return parts.select("id", text.person_name(F.col("family"), F.col("given"), F.col("display")).alias("n")).select("id", "n.*")


_TERMS = ["'Socio-Cultural/Studies (x)'", "'c++ & c#'", "'a_b;c:d'", "'  Two   Words '", "'Music [and] \"Arts\"'", "'--'", "'50% of it'"]
_TERM_KEYS = ["'socio cultural studies x'", "'c++ c#'", "'a b c d'", "'two words'", "'music and arts'", "''", "'50% of it'"]


@query("f24_term_keys", f"SELECT c_custkey AS id, trim({cases('c_custkey', _TERM_KEYS)} || ' ' || lower(c_mktsegment)) AS key FROM customer")
def f24_term_keys(spark, sf_dir):
    return rows(spark, sf_dir, "customer", {"id": "c_custkey", "t": cases("c_custkey", _TERMS) + " || '/' || c_mktsegment"}).select("id", text.term_key(F.col("t")).alias("key"))


#: Values of the sources' small parsers: input and result, by shape.
_FLAGS = [("'1'", "1"), ("' True '", "1"), ("'t'", "1"), ("'YES'", "1"), ("'y'", "1"), ("'0'", "0"), ("'false'", "0"), ("'F'", "0"), ("'no'", "0"), ("'n'", "0"), ("'maybe'", "NULL"), ("NULL", "NULL"), ("''", "NULL")]
_FORMATS = [
    ("'https://a.b/' || id || '.pdf'", "NULL", "'PDF'"), ("'https://a.b/x'", "'application/PDF'", "'PDF'"), ("'https://a.b/x.pdf'", "'text/html'", "'HTML'"), ("'https://a.b/x.MOBI'", "'image/png'", "'MOBI'"),
    ("'x.htm'", "NULL", "'HTML'"), ("'x.doc'", "NULL", "'DOCX'"), ("'x.tar'", "'text/plain'", "'TXT'"), ("'x.bin'", "NULL", "'OTHER'"), ("'x'", "'application/epub+zip'", "'EPUB'"), ("'x.xml'", "''", "'XML'"),
]
_PIDS = [
    ("'http://www.scielo.br/scielo.php?script=x&pid=S' || id", "'S' || id"), ("'http://a.b/scielo/x?pid=S' || id || '&z=1'", "'S' || id"), ("'http://a.b/x?pid=S' || id", "NULL"), ("'http://scielo.org/x'", "NULL"),
    ("'not a url'", "NULL"), ("NULL", "NULL"),
]
_ISSNS = [("'12345678, 8765432x'", "'1234-5678'", "'8765-432X'"), ("'1234-5678'", "'1234-5678'", "NULL"), ("'bad, \"00000019\"'", "'0000-0019'", "NULL"), ("''", "NULL", "NULL"), ("NULL", "NULL", "NULL")]
_TYPES = [("'Journal-Article'", "'ARTICLE'", "'OTHER'"), ("'monograph'", "'BOOK'", "'BOOK'"), ("'peer-review'", "'OTHER'", "'OTHER'"), ("NULL", "'OTHER'", "'OTHER'"), ("'dissertation'", "'THESIS'", "'THESIS'"), ("'report-series'", "'REPORT'", "'REPORT'")]
_VENUE_TYPES = [
    ("'journal'", "'JOURNAL'", "'JOURNAL'", "'JOURNAL'", "'JOURNAL'"), ("'Book-Series'", "'OTHER'", "'BOOK_SERIES'", "'OTHER'", "'OTHER'"), ("'book_series'", "'BOOK_SERIES'", "'OTHER'", "'OTHER'", "'OTHER'"),
    ("' Trade Journal '", "'OTHER'", "'OTHER'", "'OTHER'", "'JOURNAL'"), ("'conferenceproceeding'", "'OTHER'", "'CONFERENCE'", "'CONFERENCE'", "'OTHER'"), ("NULL", "'OTHER'", "'OTHER'", "'OTHER'", "'OTHER'"),
]
_SCORES = [("'1,5'", "'9'", "1.5"), ("'0.0'", "'2.5'", "2.5"), ("NULL", "'2.5'", "2.5"), ("'x'", "NULL", "NULL"), ("'3'", "'4'", "3.0")]
_INPUT = {
    "id": "id", "flag": _shape(0, _FLAGS), "url": _shape(0, _FORMATS), "kind": _shape(1, _FORMATS), "page": _shape(0, _PIDS), "issns": _shape(0, _ISSNS), "wtype": _shape(0, _TYPES), "vtype": _shape(0, _VENUE_TYPES),
    "cur": _shape(0, _SCORES), "track": _shape(1, _SCORES),
}


@query(
    "f_parsers",
    f"""SELECT id, {_shape(1, _FLAGS)} AS flag, {_shape(2, _FORMATS)} AS format, {_shape(1, _PIDS)} AS pid, {_shape(1, _ISSNS)} AS issn, {_shape(2, _ISSNS)} AS eissn, {_shape(1, _TYPES)} AS type1, {_shape(2, _TYPES)} AS type2,
    {", ".join(f"{_shape(k + 1, _VENUE_TYPES)} AS venue{k}" for k in range(4))}, CAST({_shape(2, _SCORES)} AS DOUBLE) AS score, 'cc-by' || (id % 3) AS license FROM {rows_sql("customer", {"id": "c_custkey"})}""",
)
def f_parsers(spark, sf_dir):
    d = rows(spark, sf_dir, "customer", {"id": "c_custkey"}, _INPUT)
    c, pair = F.col, ids.issn_pair(F.col("issns"))
    # The page stands first, or second among links that say nothing.
    pid = F.when(c("id") % 2 == 0, ids.scielo_pid(c("page"), F.array(F.lit("http://a.b/c")))).otherwise(ids.scielo_pid(F.lit(None).cast("string"), F.array(F.lit("http://a.b/c"), c("page"))))
    return d.select(
        "id", values.flag(c("flag")).alias("flag"), values.file_format(c("url"), c("kind")).alias("format"), pid.alias("pid"), pair["issn"].alias("issn"), pair["eissn"].alias("eissn"),
        values.work_type(c("wtype")).alias("type1"), values.work_type(c("wtype"), "openalex").alias("type2"),
        *[values.venue_type(c("vtype"), s).alias(f"venue{k}") for k, s in enumerate(values.VENUE_TYPES)], values.citescore(c("cur"), c("track")).alias("score"),
        values.license_code(F.concat(F.lit("https://x.org/licenses/CC-BY"), (c("id") % 3).cast("string"))).alias("license"),
    )


_MARKED = cases("o_orderkey", ["'Law &amp; Order '", "'a&nbsp;b '", "'plain &amp '", "'x &lt; y '", "'no entity '"]) + " || o_orderkey"
_UNMARKED = cases("o_orderkey", ["'Law & Order '", "'a b '", "'plain &amp '", "'x &lt; y '", "'no entity '"]) + " || o_orderkey"


@query(
    "r1_entities",
    f"""SELECT 'works' AS name, o_orderkey AS id, {_UNMARKED} AS value FROM orders
    UNION ALL SELECT 'venues', id, CASE WHEN n <> k AND (least_id <> id OR held) THEN k ELSE n END FROM (
      SELECT *, min(CASE WHEN n <> k THEN id END) OVER (PARTITION BY n, t) AS least_id, coalesce(bool_or(n = k) OVER (PARTITION BY n, t), false) AS held FROM (
        SELECT c_custkey AS id, c_mktsegment AS t, CASE WHEN c_custkey % 3 = 0 THEN 'A &amp; ' ELSE 'A & ' END || (c_custkey % 300) AS k, 'A & ' || (c_custkey % 300) AS n FROM customer))""",
)
def r1_entities(spark, sf_dir):
    works = rows(spark, sf_dir, "orders", {"id": "o_orderkey", "title": _MARKED})
    venues = rows(spark, sf_dir, "customer", {"id": "c_custkey", "type": "c_mktsegment", "name": "CASE WHEN c_custkey % 3 = 0 THEN 'A &amp; ' ELSE 'A & ' END || (c_custkey % 300)"})
    out = cleanup.html_entities({"works": works, "venues": venues})
    return out["works"].selectExpr("'works' name", "id", "title value").unionByName(out["venues"].selectExpr("'venues' name", "id", "name value"))


#: A value and what R2 makes of it, by column.
_DATA = {
    "pmid": [("'none'", "NULL"), ("'NaN '", "NULL"), ("''", "NULL"), ("'1' || id", "'1' || id"), ("'n/a'", "'n/a'")],
    "volume": [("'10.1/v'", "NULL"), ("'10.1'", "'10.1'"), ("'Null'", "NULL"), ("'v' || id", "'v' || id")],
    "issue": [("'10.12/' || id", "NULL"), ("'2'", "'2'"), ("NULL", "NULL")],
    "isbn": [("'978-1-' || id || ',978-2'", "'9781' || id"), ("'978' || id", "'978' || id"), ("'nan'", "NULL"), ("repeat('1-', 30)", "repeat('1', 20)")],
    "pages": [("id || '-9 pp.'", "id || '-9'"), ("'12 P'", "'12'"), ("'  7 '", "'7'"), ("'pp. 3'", "'pp. 3'"), ("'null'", "NULL")],
}


@query("r2_publication_data", f"SELECT id, {', '.join(f'{_shape(1, v)} AS {c}' for c, v in _DATA.items())} FROM {rows_sql('orders', {'id': 'o_orderkey'})}")
def r2_publication_data(spark, sf_dir):
    return cleanup.publication_data(rows(spark, sf_dir, "orders", {"id": "o_orderkey"}, {"id": "id", **{c: _shape(0, v) for c, v in _DATA.items()}}))


# Every third person is compound: one part is a stored person's name where there is one, the other two are new.
_COMPOUND = {"id": "c_custkey", "preferred_name": "CASE WHEN c_custkey % 3 = 0 THEN 'person ' || (c_custkey + 1) || ', New ' || (c_custkey % 50) || ',, Zed' ELSE 'Person ' || c_custkey END"}
_WROTE = {"work_id": "o_orderkey", "person_id": "o_custkey", "role": "CASE WHEN o_orderkey % 2 = 0 THEN 'AUTHOR' ELSE 'EDITOR' END", "position": "cast(o_orderkey % 5 as int)"}


@query(
    "r3_split_persons",
    f"""WITH p AS {rows_sql("customer", _COMPOUND)}, a AS {rows_sql("orders", _WROTE)},
    parts AS (SELECT DISTINCT id, trim(x) AS part FROM (SELECT id, unnest(string_split(preferred_name, ',')) AS x FROM p WHERE contains(preferred_name, ',')) WHERE trim(x) <> ''),
    fresh AS (SELECT part, (SELECT max(id) FROM p) + row_number() OVER (ORDER BY part) AS new_id FROM (SELECT DISTINCT part FROM parts WHERE lower(part) NOT IN (SELECT lower(preferred_name) FROM p))),
    everyone AS (SELECT id, preferred_name FROM p UNION ALL SELECT new_id, part FROM fresh),
    kept AS (SELECT * FROM everyone WHERE id NOT IN (SELECT id FROM parts)),
    added AS (SELECT DISTINCT a.work_id, e.id AS person_id FROM a JOIN parts ON a.person_id = parts.id JOIN everyone e ON lower(e.preferred_name) = lower(parts.part))
    SELECT 'person' AS kind, id AS a, preferred_name AS b, NULL AS c FROM kept
    UNION ALL SELECT 'authorship', work_id, CAST(person_id AS VARCHAR), role || position FROM a
    UNION ALL SELECT 'authorship', work_id, CAST(person_id AS VARCHAR), 'AUTHOR99' FROM added WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.work_id = added.work_id AND a.person_id = added.person_id AND role = 'AUTHOR')""",
)
def r3_split_persons(spark, sf_dir):
    people, wrote = persons.split_persons(rows(spark, sf_dir, "customer", _COMPOUND), rows(spark, sf_dir, "orders", _WROTE))
    one = people.selectExpr("'person' kind", "id a", "preferred_name b", "cast(null as string) c")
    return one.unionByName(wrote.selectExpr("'authorship' kind", "work_id a", "cast(person_id as string) b", "concat(role, position) c"))


_CATALOG = {
    "works": ("orders", {"id": "o_orderkey"}, "id % 7 <> 0"), "persons": ("customer", {"id": "c_custkey"}, "id % 5 <> 0"),
    "authorships": ("orders", {"work_id": "o_orderkey", "person_id": "o_custkey", "affiliation_id": "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 90 END"}, "work_id % 3 <> 0"),
    "publications": ("orders", {"id": "o_orderkey", "work_id": "o_orderkey", "venue_id": "o_custkey % 700", "publisher_id": "o_custkey % 11"}, "id % 2 = 0"),
    "course_instructors": ("customer", {"person_id": "c_custkey * 2", "course_id": "c_nationkey"}, "person_id % 9 = 0"), "course_bibliography": ("lineitem", {"work_id": "l_orderkey", "course_id": "l_partkey"}, "course_id % 50 = 0"),
    "funding": ("lineitem", {"work_id": "l_orderkey", "funder_id": "l_suppkey + 40"}, "funder_id % 4 = 0"), "work_references": ("lineitem", {"citing_work_id": "l_orderkey", "n": "l_linenumber"}, "n < 4"),
    "venues": ("customer", {"id": "c_custkey", "publisher_id": "CASE WHEN c_custkey % 100 = 0 THEN c_custkey % 23 END"}, "true"), "organizations": ("supplier", {"id": "s_suppkey"}, "true"),
    "files": ("orders", {"id": "o_orderkey", "publication_id": "o_orderkey + 1"}, "id % 3 = 0"), "subjects": ("part", {"id": "p_partkey"}, "true"),
    "work_subjects": ("lineitem", {"work_id": "l_orderkey", "subject_id": "l_partkey * 3"}, "true"), "venue_subjects": ("part", {"venue_id": "p_size", "subject_id": "p_partkey * 7"}, "true"), "programs": ("nation", {"institution_id": "n_nationkey * 3"}, "true"),
}
_CATALOG_SQL = ", ".join(f"{n} AS (SELECT * FROM {rows_sql(t, level)} WHERE {where})" for n, (t, level, where) in _CATALOG.items())


def _catalog(spark, sf_dir) -> dict[str, DataFrame]:
    return {n: rows(spark, sf_dir, t, level).where(where) for n, (t, level, where) in _CATALOG.items()}


def _counted(catalog: dict[str, DataFrame], names) -> DataFrame:
    """A fingerprint of each table: its rows and the sum of its first column."""
    out = None
    for n in names:
        one = catalog[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(catalog[n].columns[0]).alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


def _counted_sql(names, prefix: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, CAST(sum({next(iter(_CATALOG[n][1]))}) AS BIGINT) AS total FROM {prefix}{n}" for n in names)


_CORE = ("authorships", "publications", "course_bibliography", "funding", "work_references", "persons")


@query(
    "r4_core_data",
    f"""WITH {_CATALOG_SQL}, k_authorships AS (SELECT * FROM authorships WHERE work_id IN (SELECT id FROM works) AND person_id IN (SELECT id FROM persons)), k_publications AS (SELECT * FROM publications WHERE work_id IN (SELECT id FROM works)),
    k_course_bibliography AS (SELECT * FROM course_bibliography WHERE work_id IN (SELECT id FROM works)), k_funding AS (SELECT * FROM funding WHERE work_id IN (SELECT id FROM works)),
    k_work_references AS (SELECT * FROM work_references WHERE citing_work_id IN (SELECT id FROM works)),
    k_persons AS (SELECT * FROM persons WHERE id IN (SELECT person_id FROM k_authorships) OR id IN (SELECT person_id FROM course_instructors)) {_counted_sql(_CORE, "k_")}""",
)
def r4_core_data(spark, sf_dir):
    return _counted(cleanup.core_data(_catalog(spark, sf_dir)), _CORE)


_MORE = ("works", "files", "venues", "subjects", "organizations")


@query(
    "j7_orphans",
    f"""WITH {_CATALOG_SQL}, k_works AS (SELECT * FROM works WHERE id IN (SELECT work_id FROM authorships)), k_files AS (SELECT * FROM files WHERE publication_id IN (SELECT id FROM publications)),
    k_venues AS (SELECT * FROM venues WHERE id IN (SELECT venue_id FROM publications)), k_subjects AS (SELECT * FROM subjects WHERE id IN (SELECT subject_id FROM work_subjects) OR id IN (SELECT subject_id FROM venue_subjects)),
    k_organizations AS (SELECT * FROM organizations o WHERE EXISTS (SELECT 1 FROM authorships WHERE affiliation_id = o.id) OR EXISTS (SELECT 1 FROM funding WHERE funder_id = o.id) OR EXISTS (SELECT 1 FROM programs WHERE institution_id = o.id)
      OR EXISTS (SELECT 1 FROM publications WHERE publisher_id = o.id) OR EXISTS (SELECT 1 FROM k_venues WHERE publisher_id = o.id)) {_counted_sql(_MORE, "k_")}""",
)
def j7_orphans(spark, sf_dir):
    return _counted(cleanup.orphans(_catalog(spark, sf_dir)), _MORE)


_STORED_SIGNATURES = {"id": "s_suppkey + 1", "signature": "'FAM' || chr(cast(65 + s_suppkey % 26 as int)) || chr(cast(65 + s_suppkey % 7 as int)) || ' A'"}


@query(
    "r5_signatures",
    f"""WITH s AS (SELECT min(id) AS id, signature FROM {rows_sql("supplier", _STORED_SIGNATURES)} GROUP BY 2), m AS (SELECT id, {_shape(1, _SIGNED)} AS signature FROM {rows_sql("customer", _PEOPLE)}),
    n AS (SELECT signature, (SELECT max(id) FROM s) + row_number() OVER (ORDER BY signature) AS id FROM (SELECT DISTINCT signature FROM m WHERE signature NOT IN (SELECT signature FROM s)))
    SELECT m.id, coalesce(k.id, -1) AS signature_id, m.signature FROM m LEFT JOIN (SELECT id, signature FROM s UNION ALL SELECT id, signature FROM n) k USING (signature)""",
)
def r5_signatures(spark, sf_dir):
    people = rows(spark, sf_dir, "customer", _PEOPLE, {"id": "id", "preferred_name": _shape(0, _SIGNED), "signature_id": "-1L"})
    stored = rows(spark, sf_dir, "supplier", _STORED_SIGNATURES).groupBy("signature").agg(F.min("id").alias("id"))
    out, signatures = persons.rebuild_signatures(people, stored)
    named = signatures.select(F.col("id").alias("signature_id"), "signature")
    return out.select("id", "signature_id").join(named, "signature_id", "left")


_MISSPELT = {
    "id": "c_custkey", "family_name": cases("c_custkey", ["'Gonsalves'", "'gonsálves'", "'Gonçalves'", "'Other'"]),
    "preferred_name": cases("c_custkey", ["'Ana Gonsalves'", "'Ana ' || c_custkey || ' Gonsalves'", "'Ana Gonçalves'", "'Bea ' || c_custkey || ' Gonsalves'"]),
}


@query(
    "r19_family_name",
    f"""SELECT id, CASE WHEN id % 4 < 3 THEN 'Gonçalves' ELSE 'Other' END AS family_name,
    CASE id % 4 WHEN 0 THEN 'Ana Gonsalves' WHEN 1 THEN 'Ana ' || id || ' Gonçalves' WHEN 2 THEN 'Ana Gonçalves' ELSE 'Bea ' || id || ' Gonsalves' END AS preferred_name FROM {rows_sql("customer", _MISSPELT)}""",
)
def r19_family_name(spark, sf_dir):
    """Ana Gonsalves stays as she is, as another person has the name that she would get."""
    return persons.rename_family(rows(spark, sf_dir, "customer", _MISSPELT), "Gonsalves", "Gonçalves").select("id", "family_name", "preferred_name")


# Subjects: every listed term in its vocabulary, in changing case, and parts that no rule lists.
def _subject_rows() -> list[tuple]:
    out = []
    for v, k, t, w, terms in tiers.TIERS:
        out += [(v, k, term) for term in terms]
    return out + [("OpenAlex", "Topic", t) for t in tiers.PATCHED]


_LISTED = _subject_rows()
_SUBJECT_COLUMNS = {
    "id": "p_partkey", "term": cases("p_partkey", [f"'{t}'" if k % 2 else f"upper('{t}')" for k, (_, _, t) in enumerate(_LISTED)] + ["p_name"] * 7),
    "vocabulary": cases("p_partkey", [f"'{v}'" for v, _, _ in _LISTED] + ["'Scopus'"] * 7), "subject_type": cases("p_partkey", [f"'{k}'" for _, k, _ in _LISTED] + ["'SubjectArea'"] * 7),
    "parent_id": "CASE WHEN p_partkey % 3 = 0 THEN p_partkey - 1 END", "term_key": "p_name",
}
_RULES = " ".join(f"WHEN vocabulary = '{v}' AND subject_type = '{k}' AND lower(term) IN ({', '.join(repr(x.lower()) for x in terms)}) THEN '{t}{w}'" for v, k, t, w, terms in tiers.TIERS)


@query("m33_tiers", f"SELECT id AS subject_id, vocabulary, left(r, 1) AS tier, CAST(substr(r, 2) AS DOUBLE) AS weight FROM (SELECT *, CASE {_RULES} END AS r FROM {rows_sql('part', _SUBJECT_COLUMNS)}) WHERE r IS NOT NULL")
def m33_tiers(spark, sf_dir):
    return tiers.seed(rows(spark, sf_dir, "part", _SUBJECT_COLUMNS)).withColumn("weight", F.col("weight").cast("double"))


@query("g12_tier_report", f"SELECT vocabulary, left(r, 1) AS tier, CAST(substr(r, 2) AS DOUBLE) AS weight, count(*) AS subjects FROM (SELECT *, CASE {_RULES} END AS r FROM {rows_sql('part', _SUBJECT_COLUMNS)}) WHERE r IS NOT NULL GROUP BY 1, 2, 3")
def g12_tier_report(spark, sf_dir):
    return tiers.report(tiers.seed(rows(spark, sf_dir, "part", _SUBJECT_COLUMNS))).withColumn("weight", F.col("weight").cast("double"))


_UNPATCHED = "NOT (vocabulary = 'OpenAlex' AND subject_type = 'Subfield' AND lower(term) = 'anthropology')"
_PATCHED_SQL = f"vocabulary = 'OpenAlex' AND subject_type = 'Topic' AND lower(term) IN ({', '.join(repr(x.lower()) for x in tiers.PATCHED)})"


@query(
    "m32_taxonomy_patch",
    f"""WITH s AS (SELECT * FROM {rows_sql("part", _SUBJECT_COLUMNS)} WHERE {_UNPATCHED}), m AS (SELECT max(id) + 1 AS n FROM s)
    SELECT id, term, CASE WHEN {_PATCHED_SQL} AND parent_id IS NULL THEN n ELSE parent_id END AS parent_id FROM s, m UNION ALL SELECT n, 'Anthropology', NULL FROM m""",
)
def m32_taxonomy_patch(spark, sf_dir):
    return tiers.patch_taxonomy(rows(spark, sf_dir, "part", _SUBJECT_COLUMNS).where(_UNPATCHED)).select("id", "term", "parent_id")


@query("g24_scored_venues", "SELECT count(*) AS n FROM customer WHERE c_acctbal > 0")
def g24_scored_venues(spark, sf_dir):
    return ranking.scored(rows(spark, sf_dir, "customer", {"venue_id": "c_custkey", "total_score": "c_acctbal"}))


_TWINS = {"id": "l_orderkey * 1000000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber", "citing_work_id": "l_orderkey", "cited_doi": "'10.1/X' || (l_partkey % 4) || CASE l_suppkey % 4 WHEN 0 THEN '.' WHEN 1 THEN ' ;' ELSE '' END"}


@query(
    "m29_doi_twins",
    f"""WITH r AS {rows_sql("lineitem", _TWINS)} SELECT id, citing_work_id, cited_doi FROM r WHERE NOT (regexp_matches(cited_doi, '[.,;:]$|[ ]') AND EXISTS (
      SELECT 1 FROM r o WHERE o.citing_work_id = r.citing_work_id AND o.id <> r.id AND lower(o.cited_doi) = lower(regexp_replace(replace(r.cited_doi, ' ', ''), '[.,;:]+$', ''))))""",
)
def m29_doi_twins(spark, sf_dir):
    return cleanup.without_doi_twins(rows(spark, sf_dir, "lineitem", _TWINS))


_SIGNALS = {
    "title": cases("o_orderkey", ["'A: B ' || o_orderkey", "'LOUD TITLE'", "'quiet title here'", "'. dot'", "'Plain'", "NULL"]), "subtitle": cases("o_orderkey", ["NULL", "'SHOUT'", "'whisper'", "'Fine'"]),
    "abstract": cases("o_orderkey", ["'<p>x</p>'", "'a < b'", "NULL"]),
}


@query(
    "p12_profile",
    f"""WITH w AS {rows_sql("orders", _SIGNALS)} SELECT 'works.title leading punct' AS label, count(*) FILTER (WHERE title LIKE '.%') AS n FROM w UNION ALL SELECT 'works.abstract html', count(*) FILTER (WHERE abstract LIKE '<p>%') FROM w
    UNION ALL SELECT 'works.title with : and no subtitle', count(*) FILTER (WHERE title LIKE '%:%' AND subtitle IS NULL) FROM w UNION ALL SELECT 'works.title ALL CAPS', count(*) FILTER (WHERE title = upper(title) AND length(title) > 3) FROM w
    UNION ALL SELECT 'works.title all lowercase', count(*) FILTER (WHERE title = 'quiet title here') FROM w UNION ALL SELECT 'works.subtitle ALL CAPS', count(*) FILTER (WHERE subtitle = 'SHOUT') FROM w
    UNION ALL SELECT 'works.subtitle all lowercase', count(*) FILTER (WHERE subtitle = 'whisper') FROM w UNION ALL SELECT 'venues.issn without hyphen', count(*) FILTER (WHERE c_custkey % 2 = 0) FROM customer
    UNION ALL SELECT 'publications.doi upper', count(*) FILTER (WHERE o_orderkey % 5 = 0) FROM orders UNION ALL SELECT 'publications.doi prefixed', count(*) FILTER (WHERE o_orderkey % 4 = 0) FROM orders
    UNION ALL SELECT 'publications placeholders', count(*) FILTER (WHERE o_orderkey % 6 = 0 OR o_orderkey % 10 = 0) FROM orders
    UNION ALL SELECT 'persons.preferred_name leading punct', count(*) FILTER (WHERE c_custkey % 3 = 0) FROM customer
    UNION ALL SELECT 'organizations.name double spaces', count(*) FILTER (WHERE s_suppkey % 2 = 0) FROM supplier
    UNION ALL SELECT 'venues.name leading punct', count(*) FILTER (WHERE c_custkey % 4 = 0) FROM customer
    UNION ALL SELECT 'venues.eissn without hyphen', count(*) FILTER (WHERE c_custkey % 5 = 0) FROM customer
    UNION ALL SELECT 'work_references.cited_doi upper', count(*) FILTER (WHERE l_partkey % 3 = 0) FROM lineitem""",
)
def p12_profile(spark, sf_dir):
    """All sixteen signals, each over a whole table."""
    venues = rows(spark, sf_dir, "customer", {
        "issn": "CASE WHEN c_custkey % 2 = 0 THEN '1234567x' ELSE '1234-5678' END", "eissn": "CASE WHEN c_custkey % 5 = 0 THEN '12345678' END", "name": "CASE WHEN c_custkey % 4 = 0 THEN '- V' ELSE 'V-' END",
    })
    pubs = rows(spark, sf_dir, "orders", {
        "doi": "CASE WHEN o_orderkey % 4 = 0 THEN 'https://doi.org/' ELSE '' END || '10.1/' || CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE 'x' END",
        "volume": "CASE WHEN o_orderkey % 6 = 0 THEN ' None ' END", "issue": "'x'", "pages": "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE '1-2' END",
    })
    return cleanup.profile({
        "works": rows(spark, sf_dir, "orders", _SIGNALS), "venues": venues, "publications": pubs,
        "persons": rows(spark, sf_dir, "customer", {"preferred_name": "CASE WHEN c_custkey % 3 = 0 THEN '. Ana' ELSE 'Ana.' END"}),
        "organizations": rows(spark, sf_dir, "supplier", {"name": "CASE WHEN s_suppkey % 2 = 0 THEN 'A  B' ELSE 'A B' END"}),
        "work_references": rows(spark, sf_dir, "lineitem", {"cited_doi": "CASE WHEN l_partkey % 3 = 0 THEN '10.1/A' ELSE '10.1/a' END"}),
    })


_RAW_IDS = {"id": "o_orderkey", "doi": cases("o_orderkey", ["'https://doi.org/10.1/A' || o_orderkey", "'10.1/b' || o_orderkey || '.'", "'doi:10.1/ C' || (o_orderkey % 50)", "NULL"]), "isbn": "' 97 8x'"}


@query(
    "c10_identifiers",
    f"""WITH p AS {rows_sql("orders", _RAW_IDS)}, n AS (SELECT id, doi, CASE id % 4 WHEN 0 THEN '10.1/a' || id WHEN 1 THEN '10.1/b' || id WHEN 2 THEN '10.1/c' || (id % 50) END AS new FROM p)
    SELECT id, CASE WHEN new IS NOT NULL AND id = min(id) OVER (PARTITION BY new) THEN new ELSE doi END AS doi, '978X' AS isbn FROM n""",
)
def c10_identifiers(spark, sf_dir):
    return cleanup.identifier_phase({"publications": rows(spark, sf_dir, "orders", _RAW_IDS)})["publications"]


_TITLES = [
    ("'LOUD: a b'", "'LOUD: a b'"), ("'ALL LOUD WORDS'", "'All Loud Words'"), ("'all quiet words'", "'All Quiet Words'"), ("'lower First ' || id", "'Lower First ' || id"), ("'n/a'", "NULL"), ("NULL", "NULL"), ("' Null '", "NULL"),
]


@query("c10_sentinels_and_titles", f"SELECT id, {_shape(1, _TITLES)} AS title FROM {rows_sql('orders', {'id': 'o_orderkey'})}")
def c10_sentinels_and_titles(spark, sf_dir):
    works = rows(spark, sf_dir, "orders", {"id": "o_orderkey"}, {"id": "id", "title": _shape(0, _TITLES)})
    return cleanup.capitalization_phase(cleanup.sentinel_phase({"works": works}))["works"]
