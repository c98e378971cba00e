"""Queries of loads with rejects, counted clean-up, deletion, repaired roles, misspelt names and title case; registered with those of `registry`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import places
from ..operators import cleanup_counts, titles
from ..scratch import Scratch
from ..sources.records import _MESSAGE
from . import delete_works, ingest, load
from .registry import as_schema, query, spread, table
from .stored import cases, rows

#: A raw record by the last digit of its order: broken, filtered, without DOI, without title, of a type and of a title that aren't loaded, one DOI
#: for many, stored already, and two that are loaded.
_DOI = "CASE k % 10 WHEN 6 THEN concat('10.5/same', cast(floor(k / 100) AS bigint)) ELSE concat('10.5/k', k) END"
_MESSAGE_SQL = f"""named_struct('DOI', CASE WHEN k % 10 <> 2 THEN {_DOI} END, 'type', CASE WHEN k % 10 = 4 THEN 'editorial' ELSE 'article' END,
  'title', CASE k % 10 WHEN 3 THEN CAST(NULL AS ARRAY<STRING>) WHEN 5 THEN array('Untitled') ELSE array(concat('On the Matter of ', k)) END)"""


@query(
    "c2_load_rejects",
    """
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 10 AS s FROM orders),
    l AS (SELECT *, s = 6 AND k <> min(CASE WHEN s = 6 THEN k END) OVER (PARTITION BY k // 100) AS again FROM o),
    r AS (SELECT CASE s WHEN 0 THEN 'unreadable' WHEN 1 THEN 'crossref:status' WHEN 2 THEN 'crossref:missing-doi' WHEN 3 THEN 'crossref:missing-title' WHEN 4 THEN 'crossref:work_type'
                 WHEN 5 THEN 'crossref:title_exact' WHEN 6 THEN CASE WHEN again THEN 'duplicate' ELSE 'loaded' END WHEN 7 THEN 'skipped:mode' ELSE 'loaded' END AS what FROM l)
    SELECT what, count(*) AS n FROM r GROUP BY 1
    UNION ALL SELECT 'counted: read', count(*) FROM r
    UNION ALL SELECT 'counted: rejected', count(*) FROM r WHERE what <> 'loaded'
    UNION ALL SELECT 'counted: inserted', count(*) FROM r WHERE what = 'loaded'
    UNION ALL SELECT 'works', count(*) FROM r WHERE what IN ('loaded', 'skipped:mode')
    """,
)
def c2_load_rejects(spark, sf_dir):
    """Every raw record is loaded or rejected for one reason, and the observed counts add up."""
    o = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey k"))
    whole = F.to_json(F.struct(F.when(F.col("k") % 10 == 1, "filtered").alias("status"), F.expr(_MESSAGE_SQL).alias("message")))
    raw = o.select(F.concat(F.lit("/w/"), F.lpad(F.col("k").cast("string"), 12, "0")).alias("path"), F.when(F.col("k") % 10 == 0, '{"message": {"DOI": "10.5/').otherwise(whole).alias("value"))
    c = load.empty(spark)
    held = o.where("k % 10 = 7")
    c["works"] = c["works"].unionByName(held.selectExpr("k + 1 id", "concat('Stored ', k) title"), allowMissingColumns=True)
    c["publications"] = c["publications"].unionByName(held.selectExpr("k + 1 id", "k + 1 work_id", "concat('10.5/k', k) doi"), allowMissingColumns=True)
    done = ingest.load_works(c, raw, "crossref", "new")
    counted = [(f"counted: {x}", done.counters[x]) for x in ("read", "rejected", "inserted")]
    loaded = done.catalog["works"].join(held.selectExpr("k + 1 id"), "id", "left_anti").agg(F.lit("loaded").alias("what"), F.count(F.lit(1)).alias("n"))
    works = done.catalog["works"].agg(F.lit("works").alias("what"), F.count(F.lit(1)).alias("n"))
    return done.rejects.groupBy(ingest.kind_of(F.col("reason")).alias("what")).agg(F.count(F.lit(1)).alias("n")).unionByName(loaded).unionByName(works).unionByName(spark.createDataFrame(counted, "what string, n long"))


_ANA = "concat('Fam', chr(cast(97 + k % 26 AS int)), chr(cast(97 + k % 7 AS int)))"
_BO = "concat('Ed', chr(cast(97 + k % 13 AS int)), 'son')"


@query(
    "m37_apply_roles",
    f"""
    WITH o AS (SELECT o_orderkey AS k, o_orderkey + 1 AS work_id, 'Ana ' || {_ANA} AS ana, 'Bo ' || {_BO} AS bo, 'Institute ' || chr(CAST(97 + o_orderkey % 5 AS INT)) AS inst FROM (SELECT *, o_orderkey AS k FROM orders)),
    s AS (SELECT * FROM o WHERE k % 3 <> 0)
    SELECT 'applied' AS stage, work_id, ana AS name, 'AUTHOR' AS role, inst AS affiliation FROM s
    UNION ALL SELECT 'applied', work_id, bo, 'EDITOR', NULL FROM s
    UNION ALL SELECT 'undone', work_id, ana, CASE WHEN k % 3 = 1 THEN 'TRANSLATOR' ELSE 'AUTHOR' END, NULL FROM s
    UNION ALL SELECT 'action', work_id, ana, CASE WHEN k % 3 = 1 THEN 'reclassify' ELSE 'update' END, NULL FROM s
    UNION ALL SELECT 'action', work_id, bo, 'insert', NULL FROM s
    """,
)
def m37_apply_roles(spark, sf_dir):
    """Roles of stored works applied (authors stored, editors made), a second run's actions, of which there must be none, and the table after an undo."""
    record = f"""named_struct('DOI', concat('10.5/k', k), 'title', array('T'), 'author', array(named_struct('given', 'Ana', 'family', {_ANA}, 'affiliation', array(named_struct('name', concat('Institute ', chr(cast(97 + k % 5 AS int))))))),
      'editor', array(named_struct('given', 'Bo', 'family', {_BO})))"""
    o = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey k"))
    message = as_schema(o, record, _MESSAGE.replace("\n", ""))
    works = o.select(F.concat(F.lit("10.5/k"), F.col("k").cast("string")).alias("doi"), message.alias("message"), F.concat(F.lit("/w/"), F.col("k").cast("string")).alias("path"))
    # Written down once: every use would build the records, and the tables, anew.
    scratch = Scratch(spark, "fixture")
    works = scratch.write(works, "records")
    c, held = load.empty(spark), o.where("k % 3 <> 0")
    put = lambda name, df: scratch.write(c[name].unionByName(df, allowMissingColumns=True), name)
    people = held.selectExpr("k % 182 + 1 id", f"concat('Ana ', {_ANA}) preferred_name").distinct()
    c = c | {
        "works": put("works", held.selectExpr("k + 1 id", "'T' title")), "publications": put("publications", held.selectExpr("k + 1 id", "k + 1 work_id", "concat('10.5/k', k) doi")), "persons": put("persons", people),
        "organizations": put("organizations", spark.range(5).selectExpr("id + 1 id", "concat('Institute ', chr(cast(97 + id as int))) name", "'INSTITUTE' type")),
        "authorships": put("authorships", held.selectExpr("k + 1 work_id", "k % 182 + 1 person_id", "case when k % 3 = 1 then 'TRANSLATOR' else 'AUTHOR' end role", "1 position", "0 is_corresponding")),
    }
    after, before, actions = load.apply_roles(c, works)
    _, _, again = load.apply_roles(after, works)
    who, where = after["persons"].select(F.col("id").alias("person_id"), F.col("preferred_name").alias("name")), c["organizations"].select(F.col("id").alias("affiliation_id"), F.col("name").alias("affiliation"))

    def shown(rows_, stage, role="role"):
        placed = rows_.join(who, "person_id").join(where, "affiliation_id", "left") if "affiliation_id" in rows_.columns else rows_.join(who, "person_id").withColumn("affiliation", F.lit(None).cast("string"))
        return placed.select(F.lit(stage).alias("stage"), "work_id", "name", F.col(role).alias("role"), "affiliation")

    undone = load.undo_roles(after["authorships"], before)
    out = shown(after["authorships"], "applied").unionByName(shown(undone, "undone"))
    return out.unionByName(shown(actions, "action", "action")).unionByName(shown(again, "again", "action"))


_WORKS = {
    "id": "o_orderkey", "k": "o_orderkey",
    "title": cases("o_orderkey", ["'main title: a sub part'", "'No Colon Here'", "'Ends with colon:'", "CAST(NULL AS STRING)", "'ALL CAPITALS HERE'", "'Has: a subtitle'"]),
    "subtitle": "CASE WHEN o_orderkey % 6 = 5 THEN 'Own' END",
}
_DIGITS = "lpad(cast(o_orderkey - o_orderkey % 4 + CASE WHEN o_orderkey % 4 = 2 THEN 2 ELSE 0 END AS varchar(9)), 8, '0')"
_VENUES = {
    "id": "o_orderkey",
    "issn": f"CASE o_orderkey % 4 WHEN 0 THEN {_DIGITS} WHEN 1 THEN concat(substr({_DIGITS}, 1, 4), '-', substr({_DIGITS}, 5, 4)) WHEN 2 THEN {_DIGITS} END",
}
_LIMIT = 400


@query(
    "c10_counters",
    f"""
    WITH w AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS at FROM orders),
    t AS (SELECT *, row_number() OVER (ORDER BY k) AS t_at FROM w WHERE k % 6 IN (0, 2)),
    i AS (SELECT *, row_number() OVER (ORDER BY k) AS i_at FROM w WHERE k % 4 <> 3),
    v AS (SELECT *, row_number() OVER (ORDER BY k) AS v_at FROM w),
    l AS (SELECT unnest([NULL, {_LIMIT}]) AS limited)
    SELECT limited, 'title_subtitle' AS phase, 'title' AS "column", count(k) AS scanned, count(k) FILTER (WHERE k % 6 = 0) AS changed, count(k) FILTER (WHERE k % 6 = 0) AS updated, CAST(0 AS BIGINT) AS skipped_integrity,
           count(k) FILTER (WHERE k % 6 = 2) AS skipped_empty
    FROM l LEFT JOIN t ON limited IS NULL OR t_at <= limited GROUP BY 1
    UNION ALL
    SELECT limited, 'identifiers', 'issn', count(k), count(k) FILTER (WHERE k % 4 IN (0, 2)), count(k) FILTER (WHERE k % 4 = 2 OR k % 4 = 0 AND k + 1 NOT IN (SELECT k FROM w)),
           count(k) FILTER (WHERE k % 4 = 0 AND k + 1 IN (SELECT k FROM w)), 0
    FROM l LEFT JOIN i ON limited IS NULL OR i_at <= limited GROUP BY 1
    UNION ALL
    SELECT limited, 'sentinel', 'volume', count(k), count(k) FILTER (WHERE k % 5 = 0), count(k) FILTER (WHERE k % 5 = 0), 0, 0 FROM l LEFT JOIN v ON limited IS NULL OR v_at <= limited GROUP BY 1
    """,
)
def c10_counters(spark, sf_dir):
    """Counters of three phases over all values of a column, and over the first so many by id."""
    c = {
        "works": rows(spark, sf_dir, "orders", _WORKS).drop("k"), "venues": rows(spark, sf_dir, "orders", _VENUES),
        "publications": table(spark, sf_dir, "orders").selectExpr("o_orderkey id", "case when o_orderkey % 5 = 0 then 'n/a' else concat('v', o_orderkey) end volume"),
    }
    out = None
    for limit in (None, _LIMIT):
        parts = [
            cleanup_counts.run_counted(spark, c, ("title_subtitle",), limit=limit)[1], cleanup_counts.run_counted(spark, c, ("identifiers",), limit=limit)[1],
            cleanup_counts.run_counted(spark, c, ("sentinel",), ("publications",), limit)[1],
        ]
        for part in parts:
            one = part.select(F.lit(limit).cast("int").alias("limited"), "phase", "column", *cleanup_counts.COUNTERS)
            out = one if out is None else out.unionByName(one)
    return out


#: Every literal and prefix of the junk rules, then titles of works.
_JUNK = [*titles.PLACEHOLDERS, *titles.BOILERPLATE, *[f"{p}x" for p in titles.PREFIXES]]
_GOOD = ["12. On Rivers", "Dots... and More", "A Plain Title", "Notes from a Journey"]
_SHOWN = ["On Rivers", "Dots… and More", "A Plain Title", "Notes from a Journey"]


def _choice(by: str, choices: list[str]) -> str:
    quoted = ", ".join("'" + x.replace("'", "''") + "'" for x in choices)
    return f"element_at(array({quoted}), cast({by} % {len(choices)} + 1 AS int))"


def _choice_sql(by: str, choices: list[str]) -> str:
    quoted = ", ".join("'" + x.replace("'", "''") + "'" for x in choices)
    return f"list_extract([{quoted}], CAST({by} % {len(choices)} + 1 AS INT))"


@query(
    "p4_delete_script",
    f"""
    WITH w AS (SELECT o_orderkey AS k, o_orderkey % 4 = 0 AS junk FROM orders),
    s AS (SELECT * FROM w WHERE NOT junk AND k % 11 <> 0),
    p AS (SELECT k, k % 50 AS venue_id, CASE WHEN k % 50 % 3 = 0 OR k % 2 = 0 THEN 1 ELSE 0 END AS oa FROM w WHERE NOT junk)
    SELECT 'work' AS kind, k AS id, {_choice_sql('k', _SHOWN)} AS a, CASE k % 5 WHEN 0 THEN 'text ' || k WHEN 1 THEN 'dash ' || k WHEN 3 THEN 'Plain ' || k WHEN 4 THEN 'Of late ' || k END AS b FROM s
    UNION ALL SELECT 'gone', k, NULL, NULL FROM w WHERE junk
    UNION ALL SELECT 'venue', venue_id, NULL, '' || count(*) || ' ' || sum(oa) FROM p GROUP BY 2
    UNION ALL SELECT 'authorships', count(*), NULL, NULL FROM s
    """,
)
def p4_delete_script(spark, sf_dir):
    """What the deletion leaves: works with trimmed titles and abstracts, venues with their publications and how many are open, authorships."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey k")
    junk, abstract = _choice("cast(floor(k / 4) AS bigint)", _JUNK), cases("k", ["concat('Abstract: text ', k)", "concat(' – dash ', k)", "'Resumo'", "concat('Plain ', k)", "concat('RÉSUMÉ Of late ', k)"])
    c = {
        "works": o.selectExpr("k id", f"CASE WHEN k % 4 = 0 THEN {junk} ELSE {_choice('k', _GOOD)} END title", "CAST(NULL AS STRING) subtitle", f"{abstract} abstract", "'ARTICLE' work_type"),
        "authorships": o.where("k % 11 <> 0").selectExpr("k work_id", "k person_id", "'AUTHOR' role", "cast(null as bigint) affiliation_id"),
        "publications": o.selectExpr("k id", "k work_id", "k % 50 venue_id", "cast(null as bigint) publisher_id", "0 open_access", "case when k % 2 = 0 then 'http://l' end license_url", "cast(null as string) scielo_pid"),
        "venues": table(spark, sf_dir, "customer").selectExpr("c_custkey id", "cast(null as bigint) publisher_id", "case when c_custkey % 3 = 0 then 1 else 0 end open_access"),
    }
    out, gone = delete_works.delete_works(c)
    none = F.lit(None).cast("string")
    of = out["publications"].groupBy(F.col("venue_id").alias("id")).agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.sum("open_access").cast("string")).alias("b"))
    shown = out["works"].select(F.lit("work").alias("kind"), "id", F.col("title").alias("a"), F.col("abstract").alias("b"))
    shown = shown.unionByName(gone.select(F.lit("gone").alias("kind"), "id", none.alias("a"), none.alias("b")))
    shown = shown.unionByName(out["venues"].join(of, "id", "left").select(F.lit("venue").alias("kind"), "id", none.alias("a"), "b"))
    return shown.unionByName(out["authorships"].agg(F.lit("authorships").alias("kind"), F.count(F.lit(1)).alias("id"), none.alias("a"), none.alias("b")))


#: Names of nations, misspelt by what a customer's key leaves: as they are, a letter lost, doubled, wrong, two letters changed, several.
_MISSPELT = cases(
    "c_custkey",
    ["n_name", "concat(substr(n_name, 1, 2), substr(n_name, 4))", "concat(substr(n_name, 1, 3), substr(n_name, 3))", "concat('x', substr(n_name, 2))", "concat(substr(n_name, 1, 1), 'zz', substr(n_name, 4))", "concat('qq', n_name, c_custkey)", "lower(n_name)"],
)


@query(
    "f51_misspelt_names",
    f"""
    WITH q AS (SELECT DISTINCT {_MISSPELT} AS name FROM customer JOIN nation ON c_nationkey = n_nationkey),
    p AS (SELECT name, n_name AS match, levenshtein(lower(trim(name)), lower(n_name)) AS edits, CASE WHEN length(n_name) < 4 THEN 0 WHEN length(n_name) < 8 THEN 1 ELSE 2 END AS most FROM q, nation)
    SELECT name, arg_min(match, (edits, match)) AS match, CAST(min(edits) AS INTEGER) AS edits FROM p WHERE edits <= most GROUP BY name
    """,
)
def f51_misspelt_names(spark, sf_dir):
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return places.closest_names(joined.selectExpr(f"{_MISSPELT} AS name"), table(spark, sf_dir, "nation").selectExpr("n_name match"))


#: Words as they stand first, inside and last in a title, and what each becomes there.
_WORDS = [
    (["of", "o'neil", "state-of-the-art", "the", "mcdonald", "iPhone", "l'amour"], ["Of", "O'Neil", "State-of-the-Art", "The", "McDonald", "iPhone", "l'Amour"]),
    (["and", "war:", "u.s.", "in-house", "d'artagnan", "via"], ["and", "War:", "u.s.", "in-House", "d'Artagnan", "via"]),
    (["the", "rivers", "either/or", "of", "'twas"], ["the", "Rivers", "Either/or", "of", "'Twas"]),
    (["for", "peace", "time-and-tide", "up"], ["For", "Peace", "Time-and-Tide", "Up"]),
]


@query(
    "f40_title_case",
    f"""
    WITH w AS (SELECT o_orderkey AS id, o_orderkey AS k, CASE WHEN o_orderkey // 7 % 6 = 1 THEN true ELSE false END AS colon FROM orders),
    p AS (SELECT *, {_choice_sql('k', _WORDS[0][1])} AS a, {_choice_sql('(k // 7)', _WORDS[1][1])} AS b, {_choice_sql('(k // 3)', _WORDS[2][1])} AS c, {_choice_sql('(k // 11)', _WORDS[3][1])} AS d FROM w)
    SELECT id, a || ' ' || b || ' ' || CASE WHEN colon AND c IN ('the', 'of') THEN upper(c[1]) || c[2:] ELSE c END || ' ' || d AS title FROM p
    """,
)
def f40_title_case(spark, sf_dir):
    """Titles of four words: small ones, joined ones, names, a colon, forms of their own."""
    by = ["k", "cast(floor(k / 7) AS bigint)", "cast(floor(k / 3) AS bigint)", "cast(floor(k / 11) AS bigint)"]
    words = ", ' ', ".join(_choice(x, w) for x, (w, _) in zip(by, _WORDS))
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey k").selectExpr("k id", f"concat({words}) t").select("id", places.title_case(F.col("t")).alias("title"))
