"""Scalar functions on hand-checked values, and the small readers and writers."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from foliant.functions import identifiers as ids
from foliant.functions import text, values
from foliant.operators import keys
from foliant.plans import transform
from foliant.sources import records, sinks

L = F.lit
def cases():
    """Expressions, which need a session to be made, and their values."""
    NONE = L(None).cast("string")
    ints = lambda *x: F.array(*map(L, x)).cast("array<int>")
    strings = lambda *x: F.array(*map(L, x)).cast("array<string>")

    return [
        (ids.doi_at_load(L("https://doi.org/10.1080/ABC.")), "10.1080/abc"), (ids.doi_at_load(L("doi: 10.1177/026 123")), "10.1177/026123"), (ids.doi_at_load(L("11.1/x")), None), (ids.doi_at_load(L("10.1/a&eacute;&lt;b")), "10.1/aé<b"),
        (ids.doi_at_transform(L("11.1/X;")), "11.1/x"), (ids.doi_at_transform(L("")), ""), (ids.doi_of_work(L("https://doi.org/10.1/AB")), "10.1/ab"), (ids.doi_of_work(L("10.1/x.")), "10.1/x."),
        (ids.issn(L("1234567x")), "1234-567X"), (ids.issn(L("1234-56")), None), (ids.issn_cleaned(L("1234567x")), "1234-567X"), (ids.issn_cleaned(L(" 1234-56 ")), "1234-56"),
        (ids.lookup_issn(L("bad"), L("12345678"))["kind"], "eissn"), (ids.lookup_issn(L("1111-1111"), L("12345678"))["key"], "1111-1111"), (ids.lookup_issn(NONE, NONE)["key"], None),
        (ids.orcid_cleaned(L("https://orcid.org/0000-0002-1825-009x")), "0000-0002-1825-009X"), (ids.orcid_found(L("see 0000-0002-1825-009x!")), "0000-0002-1825-009X"), (ids.orcid_found(L("none")), None),
        (ids.isbn(L(" 97 8x")), "978X"), (ids.isbn_first(L("978-1,979-2")), "9781"), (ids.ror_id(L("https://ror.org/012ab")), "012ab"), (ids.ror_id(L("x" * 30)), "x" * 20), (ids.mag_id(L("12.0")), "12"), (ids.mag_id(L("https://m/77")), "77"),
        (ids.wikidata_id(L("http://w/Q42")), "Q42"), (ids.wikidata_id(L(" other ")), "other"), (ids.last_segment(L("https://openalex.org/A1/")), "A1"), (ids.last_segment(L(" ")), None),
        (ids.pmid(L("https://p/1234567")), "1234567"), (ids.pmid(L("1234")), None), (ids.pmcid(L("pmc12")), "PMC12"), (ids.pmcid(L(" 77 ")), "PMC77"), (ids.arxiv_id(L("https://arxiv.org/abs/2101.1")), "2101.1"), (ids.arxiv_id(L("2101.1")), "2101.1"),
        (ids.file_stem(L("10.1/a:b")), "10.1_a_b"), (ids.doi_of_file(L("/x/10.1_a_b.json")), "10.1/a_b"), (ids.doi_of_file(L("/x/a.json")), None), (ids.doi_of_file(L("/x/10.1.json")), None), (ids.venue_of_file(L("/x/12.json")), 12), (ids.venue_of_file(L("/x/v12.json")), None),
        (ids.issn_of_links(strings("http://a/?q=1", "http://a/?issn=12345678&x=1")), "1234-5678"), (ids.issn_of_links(strings("http://a/")), None), (ids.scielo_pid(L("http://www.scielo.br/x?pid=S1"), strings()), "S1"),
        (text.person_key(L("A. \"Bo\"‎ (Li)")), "a bo li"), (text.person_key(L("x")), None), (text.name_without_stops(L("A.,;B")), "A B"), (text.first_text(strings("a", "b")), "a"), (text.first_text(strings()), None),
        (text.blank_title(strings(" ")), True), (text.blank_title(strings("x")), False), (text.blank_title(L(None).cast("array<string>")), True), (text.ingest_text(L("&lt;b&gt;x&lt;/b&gt; y")), "x y"), (text.cleaned_text(L("&lt;b&gt;x&lt;/b&gt; y")), "<b>x</b> y"),
        (text.entities_in_place(L("a &amp; b &lt; ")), "a & b &lt;"), (text.entities_in_place(L("a & b ")), "a & b "), (text.abstract_of_jats(L("<jats:sec><p>gone</p></jats:sec>\n<p>kept</p>")), "kept"), (text.dots_to_ellipsis(L("a...")), "a…"),
        (text.title_from_letters(L("1968: the year")), "the year"), (text.upper_first(L("éa")), "Éa"), (text.all_upper(L("ABCd")), False), (text.all_upper(L("ABCDe")), True), (text.all_lower(L("abc")), False), (text.all_lower(L("abcd")), True),
        (text.sentinel_to_null(L("nan"), text.NONE_AT_CLEANUP), "nan"), (text.sentinel_to_null(L("N/A "), text.NONE_AT_CLEANUP), None), (text.clean_string(L("  ab "), 1), "a"), (text.clean_string(L(" ")), None), (text.whole_number(L(" 12 ")), 12), (text.whole_number(L("1.5")), None),
        (text.role(L(" Editor ")), "EDITOR"), (text.role(L("chair")), None), (text.display_name(L(" A "), L("")), "A"), (text.display_name(NONE, L(" ")), None), (text.split_title(L("A: b"), NONE)["subtitle"], "B"), (text.split_title(L("A:"), NONE)["title"], "A:"),
        (values.date_of_parts(ints(2021, 13, 5)), datetime.date(2021, 1, 5)), (values.date_of_parts(ints(999)), None), (values.date_or_year(L("2001-02-03"), L(1990)), datetime.date(2001, 2, 3)), (values.date_or_year(L("x"), L(1990)), datetime.date(1990, 1, 1)),
        (values.year_bucket(ints(0), ints(2001)), "2001"), (values.year_bucket(ints()), "unknown"), (values.stamp(L("2024-01-01T10:11:12.5Z")), datetime.datetime(2024, 1, 1, 10, 11, 12)), (values.year_within(L("unknown"), L(1), L(2)), True), (values.year_within(L("3"), L(1), L(2)), False),
        (values.language(L("EN_us")), "en"), (values.decimal_comma(L("1,5")), 1.5), (values.decimal_thousands(L("8.562")), 8.562), (values.decimal_thousands(L("8.562,5")), 8562.5), (values.flag(L("y")), 1), (values.flag(L("N")), 0), (values.flag(L("?")), None),
        (F.size(values.categories(L("Anthropology (Q1); Cultural Studies (Q2);"))), 2), (values.categories(L("A (Q1); B"))[1]["quartile"], None), (values.quartile_score(L("Q2")), 0.75), (values.pages(L("1"), L("1")), "1"), (values.pages(L("1"), L("9")), "1-9"),
        (values.pages_cleaned(L("12-20 pp.")), "12-20"), (values.not_a_doi(L("10.1/x")), None), (values.not_a_doi(L("10.1")), "10.1"), (values.citescore(L("0.0"), L("2")), 2.0), (values.first_metric(strings("1,5")), 1.5), (values.license_code(L("https://openalex.org/licenses/CC-BY ")), "cc-by"),
        (values.file_format(L("x.docx"), NONE), "DOCX"), (values.is_scielo_pdf(L("http://scielo.br/a.pdf"), NONE), True), (values.is_scielo_pdf(L("http://b/a.pdf"), NONE), False), (values.work_type(L("Thesis")), "THESIS"), (values.venue_type(L(" Journal "), "scopus"), "JOURNAL"),
        (keys.upgraded_version(L("acceptedVersion"), L("SUBMITTEDVERSION")), "acceptedVersion"), (keys.upgraded_version(NONE, L("vor")), "vor"), (keys.upgraded_version(L("x"), L("")), "x"),
    ]


def test_values(spark):
    known = cases()
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, (c, _) in enumerate(known)]).first()
    assert [(k, row[k], known[k][1]) for k in range(len(known)) if row[k] != known[k][1]] == []


def test_small_readers(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v/1.json").write_text(json.dumps({"id": "https://openalex.org/S1", "display_name": "A"}))
    (tmp_path / "v/2.json").write_text("{")
    assert [r.display_name for r in records.openalex_venues(spark, str(tmp_path / "v")).collect()] == ["A"]
    (tmp_path / "m.csv").write_text("id_venue_incorreto,issn_correto\n 7 , 1234-5678 \n")
    assert [tuple(r) for r in records.trimmed_csv(spark, str(tmp_path / "m.csv")).collect()] == [("7", "1234-5678")]
    (tmp_path / "filtered.txt").write_text("10.1/a\n\n 10.1/b \n10.1/a\n")
    ledger = records.doi_list(spark, str(tmp_path / "filtered.txt"))
    assert sorted(r.doi for r in ledger.collect()) == ["10.1/a", "10.1/b"]
    rows = spark.createDataFrame([("10.1/a",), ("10.1/c",)], "doi string")
    assert [r.doi for r in records.not_known_missing(rows, ledger).collect()] == ["10.1/c"] and [r.doi for r in records.of_keys(rows, ledger).collect()] == ["10.1/a"]
    venues = spark.createDataFrame([(2, "PENDING", 4, "1", None), (1, "PENDING", 4, None, ""), (3, "FAILED", 5, None, "2"), (4, "PENDING", 3, "3", None)], "id long, validation_status string, llm_relevance int, issn string, eissn string")
    assert [r.id for r in records.pending(venues).collect()] == [1, 2, 4] and sorted(r.id for r in records.relevant(venues, 4).collect()) == [2, 3]
    assert records.text_columns(venues, "id", unique=("issn",), skip=("eissn",)) == [("validation_status", "id", False), ("issn", "id", True)]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("insert", 1), ("insert", None), ("skip", 2)], "action string, n int")
    sinks.write_summary(rows, str(tmp_path / "s"))
    sinks.write_summary(rows.limit(1), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    for _ in range(2):
        sinks.write_log(rows, str(tmp_path / "l"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "l")).collect()]
    assert len(lines) == 6 and {"action": "insert", "n": None} in lines
    assert sorted(map(tuple, sinks.report(rows).collect())) == [("insert", 2), ("skip", 1)]


def test_transform_stops_where_it_is_told(spark):
    w = spark.createDataFrame([(1, "a &amp; b", 3, "ARTICLE")], "id long, title string, citation_count long, work_type string")
    p = spark.createDataFrame([(1, 1, 5, 2000, 0, "10.1/x", "none", "12 pp.")], "id long, work_id long, venue_id long, year int, open_access int, doi string, volume string, pages string")
    v = spark.createDataFrame([(5, "V", 1, 4)], "id long, name string, open_access int, llm_relevance int")
    people = spark.createDataFrame([(7, "Ana Silva, Bo Li"), (8, "Nobody Here")], "id long, preferred_name string")
    a = spark.createDataFrame([(1, 7, None, "AUTHOR", 1, 0)], "work_id long, person_id long, affiliation_id long, role string, position int, is_corresponding int")
    r = spark.createDataFrame([(1, "10.1/X", None, "PENDING", None)], "citing_work_id long, cited_doi string, cited_work_id long, status string, resolved_at string")
    out = transform.run({"works": w, "publications": p, "venues": v, "persons": people, "authorships": a, "references": r}, L("now"), 2001, upto=3)
    assert out["works"].first().title == "a & b" and tuple(out["publications"].select("open_access", "volume", "pages").first()) == (1, None, "12")
    assert sorted((x.preferred_name, x.signature_id is not None) for x in out["persons"].collect()) == [("Ana Silva", True), ("Bo Li", True)]
    assert sorted((x.role, x.position) for x in out["authorships"].collect()) == [("AUTHOR", 99), ("AUTHOR", 99)]
    assert tuple(out["references"].select("status", "cited_work_id", "resolved_at").first()) == ("RESOLVED", 1, "now") and "summary_venues" not in out


@pytest.mark.parametrize("index, want", [({"the": [0, 2], "cat": [1], "sat": [4]}, "the cat the  sat"), ({}, None), ({"a": []}, None), ({"x": [1], "y": [1]}, " y")])
def test_abstracts_from_their_index(spark, index, want):
    df = spark.createDataFrame([(index,)], "i map<string,array<int>>")
    assert df.select(text.abstract_of_index(F.col("i")).alias("x")).first().x == want
