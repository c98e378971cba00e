"""Scalar functions against hand-derived results (FIXTURES.md, part B)."""

from pyspark.sql import functions as F

from foliant.functions import identifiers as ids
from foliant.functions import text, values

S = F.lit


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def cases():
    return [
        (ids.doi_at_load(S("https://doi.org/10.1080/ABC.")), "10.1080/abc"),
        (ids.doi_at_load(S("doi: 10.1177/026 123")), "10.1177/026123"),
        (ids.doi_at_load(S("11.1/x")), None),
        (ids.doi_at_load(S("")), None),
        (ids.doi_at_transform(S("11.1/X;")), "11.1/x"),
        (ids.doi_at_transform(S("")), ""),
        (ids.issn(S("1234567x")), "1234-567X"),
        (ids.issn(S("1234-56")), None),
        (ids.issn_cleaned(S("1234567x")), "1234-567X"),
        (ids.issn_cleaned(S("1234-56")), "1234-56"),
        (ids.orcid_cleaned(S("https://orcid.org/0000-0002-1825-009x")), "0000-0002-1825-009X"),
        (ids.doi_of_file(S("/a/10.1_x_y.json")), "10.1/x_y"),
        (text.term_key(S("Socio-Cultural/Studies (x)")), "socio cultural studies x"),
        (text.ingest_text(S("&lt;b&gt;x&lt;/b&gt; y")), "x y"),
        (text.cleaned_text(S("&lt;b&gt;x&lt;/b&gt; y")), "<b>x</b> y"),
        (text.abstract_of_index(F.expr("map('the', array(0, 2), 'cat', array(1), 'sat', array(4))")), "the cat the  sat"),
        (text.title_from_letters(S("1968: the year")), "the year"),
        (text.all_upper(S("ABCd")), False),
        (text.all_upper(S("ABCDe")), True),
        (text.sentinel_to_null(S("nan"), text.NONE_AT_CLEANUP), "nan"),
        (text.sentinel_to_null(S("n/a"), text.NONE_AT_CLEANUP), None),
        (text.sentinel_to_null(S("nan"), text.NONE_IN_SQL), None),
        (text.signature(S("Ana de la Cruz")), "DE LA CRUZ A"),
        (text.signature(S("João Silva Neto")), "SILVA J"),
        (text.signature(S("X")), None),
        (text.signature(S("Ana Silva-Costa")), "SILVA-COSTA A"),
        (values.pages_cleaned(S("12-20 pp.")), "12-20"),
        (values.decimal_thousands(S("8,562")), 8.562),
        (values.decimal_thousands(S("8.562")), 8.562),
    ]


def test_cases(spark):
    wrong = [(k, got, want) for k, (c, want) in enumerate(cases()) if (got := one(spark, c)) != want]
    assert not wrong


def test_names(spark):
    none = S(None).cast("string")
    assert one(spark, text.person_name(none, none, S("Plato"))["preferred"]) == "Plato Plato"
    assert one(spark, text.person_name(none, none, S("Silva, Ana"))["preferred"]) == "Ana Silva"
    got = one(spark, text.person_name(none, none, S("Ana de la Cruz")))
    assert (got.given, got.surname) == ("Ana de la", "Cruz")


def test_titles(spark):
    none = S(None).cast("string")
    assert tuple(one(spark, text.split_title(S("A: b"), none))) == ("A", "B")
    assert tuple(one(spark, text.split_title(S("A:"), none))) == ("A:", None)
    assert tuple(one(spark, text.split_title(S("A: b"), S("s")))) == ("A: b", "s")


def test_categories_and_dates(spark):
    assert [tuple(x) for x in one(spark, values.categories(S("Anthropology (Q1); Cultural Studies (Q2)")))] == [("Anthropology", "Q1"), ("Cultural Studies", "Q2")]
    arr = lambda *x: F.array(*map(F.lit, x))
    assert str(one(spark, values.first_date(arr(2021, 13, 5), arr(2020)))) == "2021-01-05"
    assert str(one(spark, values.stamp(S("2024-01-01T10:11:12.5Z")))) == "2024-01-01 10:11:12"
