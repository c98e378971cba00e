"""Queries over whole texts and whole tables."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F
from test_operators import DATA

from foliant.functions import text
from foliant.functions.places import SMALL, title_case
from foliant.operators import ranking
from foliant.operators.titles import exclusion_reason
from foliant.plans import adapters, registry


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_whole_texts_reach_the_operators(spark):
    got = registry.QUERIES["f_text_whole"](spark, DATA).collect()
    want = texts(spark)
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.text_chars == r.first_chars == len(want[r.doc_id]) for r in got) and max(r.text_chars for r in got) > 1000
    assert all(r.subtitle_chars == len(want[r.doc_id].strip(" ")) for r in got if want[r.doc_id].strip(" "))
    assert sum(r.term_chars for r in got) > 0.9 * sum(map(len, want.values()))


def words_cased(s):
    s = s.lower() if s == s.upper() != s.lower() else s
    words, out = s.split(" "), []
    for i, w in enumerate(words):
        bare = "".join(c for c in w.lower() if c.isalpha())
        if re.search(r"[^\W\d_]\.[^\W\d_]", w) or any(c.islower() and any(d.isupper() for d in w[k:].split("\n")[0]) for k, c in enumerate(w)):
            out.append(w)
        elif 0 < i < len(words) - 1 and not words[i - 1].endswith(":") and bare in SMALL:
            out.append(w.lower())
        else:
            k = next((k for k, c in enumerate(w) if c.isalpha()), len(w))
            out.append(w[:k] + w[k : k + 1].upper() + w[k + 1 :])
    return " ".join(out)


def test_unicode_functions_on_whole_texts(spark):
    want = texts(spark)
    for r in registry.QUERIES["f_text_unicode"](spark, DATA).collect():
        bare = "".join(c for c in unicodedata.normalize("NFKD", want[r.doc_id]) if not unicodedata.combining(c)).lower()
        assert r.filtered == re.sub(" +", " ", re.sub(r"[^a-z0-9]", " ", bare)).removeprefix(" ").removesuffix(" ")
        assert r.cased == words_cased(want[r.doc_id])


@pytest.mark.parametrize("function, want", [(text.upper_first, "A" + "b" * 200), (text.title_from_letters, "a" + "b" * 200), (text.term_key, "a" + "b" * 200)])
def test_functions_do_not_cut(spark, function, want):
    assert spark.range(1).select(function(F.lit("a" + "b" * 200)).alias("x")).first().x == want


@pytest.mark.parametrize("word, want", [("ßx", "ẞx"), ("ᾳx", "ᾼx"), ("ŉx", "ŉx"), ("éß", "Éß"), ("ǆx", "Ǆx")])
def test_a_first_letter_becomes_one_letter_as_in_sql(spark, word, want):
    import duckdb

    assert spark.range(1).select(text.upper_first(F.lit(word)).alias("x")).first().x == want
    assert duckdb.connect().sql(f"SELECT upper('{word[0]}')").fetchall()[0][0] + word[1:] == want


def test_whole_tables(spark):
    n = {t: spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("customer", "orders", "lineitem", "part")}
    pairs = n["lineitem"].join(n["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").distinct()
    whole = adapters.Tables(spark, DATA)
    assert whole.venues.count() == n["customer"].count() > 100
    assert whole.tiers.count() == n["part"].count() > 81
    assert whole.venue_subjects.count() == pairs.count()
    ranked = registry.QUERIES["r21_venue_ranking"](spark, DATA)
    assert ranked.count() == n["customer"].count()
    merged = registry.QUERIES["m4_merge_scores"](spark, DATA)
    assert merged.select("venue_id", "subject_id").join(pairs.toDF("venue_id", "subject_id"), ["venue_id", "subject_id"]).count() == pairs.count()
    assert registry.QUERIES["r22_summary_publications"](spark, DATA).where("subjects_search is null or venue_search is null").count() == 0


def test_core_institutions_at_their_production_limit(spark):
    t = adapters.Tables(spark, DATA)
    many = ranking.core_institutions(t.authorships, t.publications, t.venues, 10**6).count()
    assert registry.QUERIES["g11_core_institutions"](spark, DATA).count() == min(500, many) > 60


def test_totals_are_rounded_as_in_sql(spark):
    """The mean of 16 topics, 29 / 16, with 0.2 for open access and 6 for relevance is a double just below 8.0125."""
    import duckdb

    make = spark.createDataFrame
    venues = make([(1, 1, 3)], "id long, open_access int, llm_relevance int")
    topics = make([(k, 100 + (k < 13), "OpenAlex", "Topic") for k in range(16)], "id long, parent_id long, vocabulary string, subject_type string")
    tiers = make([(100, "OpenAlex", "A", 1.0), (101, "OpenAlex", "A", 2.0)], "subject_id long, vocabulary string, tier string, weight double")
    linked = make([(1, k, None) for k in range(16)], "venue_id long, subject_id long, score double")
    wrote = make([], "work_id long, person_id long, affiliation_id long")
    pubs = make([], "work_id long, venue_id long")
    people = make([], "id long, h_index int")
    refs = make([], "citing_work_id long, cited_work_id long")
    total = ranking.rank(venues, linked, topics, tiers, wrote, pubs, people, refs).first().total_score
    assert total == duckdb.connect().sql("SELECT round((29 / 16)::DOUBLE + 0.2::DOUBLE + 6, 3)").fetchall()[0][0] == 8.012


def test_joined_words_with_capitals_keep_their_form(spark):
    one = lambda s: spark.range(1).select(title_case(F.lit(s)).alias("x")).first().x
    assert one("under CC BY-NC 4.0 and IN/OUT of in-house A-frames") == "Under CC BY-NC 4.0 and IN/OUT of in-House A-Frames"
    assert one("LICENSED UNDER CC BY-NC 4.0") == "Licensed Under Cc by-Nc 4.0"  # capitals throughout say nothing
    assert one("o'neil met d'artagnan, mcdonald and (o)f 'twas éa of") == "O'Neil Met d'Artagnan, McDonald and (o)f 'Twas Éa Of"


def test_marks_are_all_combining_characters(spark):
    every = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    said = ["x".join(every[k : k + 4096]) for k in range(0, len(every), 4096)]
    got = spark.createDataFrame([(k, s) for k, s in enumerate(said)], "k int, s string").select("k", text.without_marks(F.col("s")).alias("x")).collect()
    assert all(r.x == "".join(c for c in unicodedata.normalize("NFKD", said[r.k]) if not unicodedata.combining(c)) for r in got)


def test_titles_are_filtered_once_for_all_rules(spark):
    rows = spark.createDataFrame([("Índice", "article")], "title string, kind string").select(exclusion_reason(F.col("title"), F.col("kind"), "x").alias("reason"))
    assert rows.first().reason == "x:title_pattern=index-title"
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("a-z0-9") == 2


def test_ranking_equals_its_sql_where_people_or_places_are_missing(spark, tmp_path):
    """Few authorships, so that some venues have no affiliation at all; authorships of nobody; persons given twice."""
    import duckdb

    hashed = "hash(l_orderkey, l_partkey, l_linenumber)"
    odd = {
        "few": {"lineitem": f"SELECT * FROM lineitem WHERE {hashed} % 40 = 0"},
        "nobody": {"lineitem": f"SELECT * REPLACE (CASE WHEN {hashed} % 7 > 0 THEN l_suppkey END AS l_suppkey) FROM lineitem"},
        "twice": {"supplier": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier"},
    }
    for name, made in odd.items():
        con, folder = duckdb.connect(), tmp_path / name
        folder.mkdir()
        for t in ("customer", "supplier", "part", "orders", "lineitem"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
            con.sql(f"COPY ({made.get(t, f'SELECT * FROM {t}')}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
            con.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        for q in ("r21_venue_ranking", "g9_authorship_scores", "g11_core_institutions"):
            want = con.sql(registry.ORACLES[q])
            got = registry.QUERIES[q](spark, str(folder)).select(*want.columns).collect()
            assert sorted(map(tuple, got)) == sorted(want.fetchall()), (name, q)
