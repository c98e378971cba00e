"""Dates, numbers and small parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bound import let
from .text import stripped


def date_of_parts(parts: Column) -> Column:
    """a date of [year, month, day]; a month or day that can't be is 1, a year outside 1000..9999 is no date.

    A day that its month doesn't have, such as 31 February, is no date; the table's type can't hold it.
    """
    year, month, day = (F.get(parts, F.lit(k)) for k in range(3))
    month = F.when(month.between(1, 12), month).otherwise(F.lit(1))
    day = F.when(day.between(1, 31), day).otherwise(F.lit(1))
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year.between(1000, 9999), F.try_to_date(text, "yyyy-MM-dd"))


def first_date(*parts: Column) -> Column:
    return F.coalesce(*map(date_of_parts, parts))


def date_or_year(date: Column, year: Column) -> Column:
    """F53."""
    return F.coalesce(F.try_to_date(date, "yyyy-MM-dd"), F.when(year.between(1, 9999), F.make_date(year, F.lit(1), F.lit(1))))


def year_bucket(*parts: Column) -> Column:
    """F54."""
    year = lambda p: F.get(p, F.lit(0))
    return F.coalesce(*[F.when(year(p) != 0, year(p).cast("string")) for p in parts], F.lit("unknown"))


def stamp(s: Column) -> Column:
    """fractions and offsets are cut off, not applied."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(s, r"\..*$|Z$|[+-]\d{2}:?\d{2}$", ""), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))


def year_within(bucket: Column, low: Column, high: Column) -> Column:
    """what isn't a year always passes."""
    return F.coalesce(bucket.try_cast("int").between(low, high), F.lit(True))


def language(s: Column) -> Column:
    """F57."""
    return F.left(F.lower(F.get(F.split(F.trim(s), "[-_]"), F.lit(0))), F.lit(3))


def decimal_comma(s: Column) -> Column:
    """F58."""
    return F.replace(F.trim(s), F.lit(","), F.lit(".")).try_cast("double")


def decimal_thousands(s: Column) -> Column:
    """with a comma, dots are thousands."""
    t = F.trim(s)
    return F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(t).try_cast("double")


def flag(s: Column) -> Column:
    """F60."""
    t = F.lower(stripped(s.cast("string")))
    return F.when(t.isin("1", "true", "t", "yes", "y"), 1).when(t.isin("0", "false", "f", "no", "n"), 0)


def categories(s: Column) -> Column:
    """array of (term, quartile) of `term (Qn); ...`."""
    one = lambda x: F.struct(
        F.trim(F.regexp_replace(x, r"\(Q[1-4]\)\s*$", "")).alias("term"), F.regexp_substr(x, F.lit(r"Q[1-4](?=\)\s*$)")).alias("quartile")
    )
    return F.filter(F.transform(F.split(s, ";"), one), lambda x: x["term"] != "")


def quartile_score(q: Column) -> Column:
    """F63."""
    return F.when(q == "Q1", 1.0).when(q == "Q2", 0.75).when(q == "Q3", 0.5).when(q == "Q4", 0.25)


def pages(first: Column, last: Column) -> Column:
    """F72."""
    return F.when(first.isNotNull() & last.isNotNull() & (first != last), F.concat_ws("-", first, last)).otherwise(F.coalesce(first, last))


def pages_cleaned(s: Column) -> Column:
    """F45."""
    return F.trim(F.regexp_replace(s, r"(?i)\s+pp?\.?$", ""))


def not_a_doi(s: Column) -> Column:
    """F44."""
    return F.when(~s.like("10.%/%"), s)


def rounded(x: Column, places: int) -> Column:
    """A double to so many places, by its multiple as SQL does it; Spark's own round() goes by the digits that are shown, so 8.0125, which is a little less, went up."""
    scale = float(10**places)
    return F.round(x * scale) / scale


def confidence(n: Column) -> Column:
    """F73."""
    return F.least(F.lit(1.0), F.log(1 + n) / F.log(F.lit(51.0)))


def capped_ratio(x: Column, n: Column, k: float, cap: float = 2.0) -> Column:
    """NULL as soon as either is, unlike least()."""
    r = x * 100 / F.when(n != 0, n) / k
    return F.when(r.isNotNull(), F.least(r, F.lit(cap)))


def first_metric(values: Column) -> Column:
    """F64: the number in the first of a list."""
    return decimal_comma(F.get(values, F.lit(0)))


def citescore(current: Column, tracker: Column) -> Column:
    """F64: the current metric, the tracker's where that is missing or 0."""
    now = decimal_comma(current)
    return F.coalesce(F.when(now != 0, now), decimal_comma(tracker))


def homepage(url: Column, links: Column) -> Column:
    """the address itself, or of links (ref, href) the homepage, or the source's page; 512 characters."""
    clean = lambda c: F.left(F.when(stripped(c) != "", stripped(c)), F.lit(512))
    link = lambda ref: F.get(F.filter(F.transform(F.filter(links, lambda x: stripped(x["ref"]) == ref), lambda x: clean(x["href"])), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(clean(url), link("homepage"), link("scopus-source"))


#: Formats by what a content type contains and by how an address ends, in order.
FORMATS_BY_TYPE = {"pdf": "PDF", "epub": "EPUB", "html": "HTML", "xml": "XML", "text": "TXT"}
FORMATS_BY_END = {".pdf": "PDF", ".epub": "EPUB", ".mobi": "MOBI", ".html": "HTML", ".htm": "HTML", ".xml": "XML", ".doc": "DOCX", ".docx": "DOCX", ".txt": "TXT"}


def file_format(url: Column, content_type: Column) -> Column:
    """by the content type, else by the address."""
    kind, address = F.lower(content_type), F.lower(url)
    tests = [(kind.contains(k), v) for k, v in FORMATS_BY_TYPE.items()] + [(address.endswith(k), v) for k, v in FORMATS_BY_END.items()]
    out = F.when(tests[0][0], tests[0][1])
    for test, value in tests[1:]:
        out = out.when(test, value)
    return out.otherwise("OTHER")


def is_scielo_pdf(url: Column, content_type: Column) -> Column:
    """a PDF at an address whose host or path names scielo."""
    address = F.lower(url)
    place = F.concat_ws("", F.try_parse_url(address, F.lit("HOST")), F.try_parse_url(address, F.lit("PATH")))
    return F.coalesce(F.when(place != "", place).otherwise(address).contains("scielo") & (file_format(url, content_type) == "PDF"), F.lit(False))


#: Work types of the sources; those that aren't listed, and those listed as other there, are OTHER.
WORK_TYPES = {
    "journal-article": "ARTICLE", "article": "ARTICLE", "book-chapter": "CHAPTER", "book": "BOOK", "proceedings-article": "CONFERENCE", "dataset": "DATASET",
    "report": "REPORT", "thesis": "THESIS", "book-section": "CHAPTER", "monograph": "BOOK", "reference-book": "BOOK", "proceedings": "CONFERENCE",
    "report-series": "REPORT", "dissertation": "THESIS",
}
#: The second source knows no journal-article.
WORK_TYPES_2 = {k: v for k, v in WORK_TYPES.items() if k != "journal-article"}
#: Venue types of the four sources, by source.
VENUE_TYPES = {
    "openalex-works": {"journal": "JOURNAL", "conference": "CONFERENCE", "book_series": "BOOK_SERIES", "repository": "REPOSITORY"},
    "openalex": {"journal": "JOURNAL", "tradejournal": "JOURNAL", "conference": "CONFERENCE", "conferenceproceeding": "CONFERENCE", "repository": "REPOSITORY", "book-series": "BOOK_SERIES", "bookseries": "BOOK_SERIES"},
    "scopus": {"journal": "JOURNAL", "tradejournal": "JOURNAL", "conferenceproceeding": "CONFERENCE", "bookseries": "BOOK_SERIES"},
    "scimago": {"journal": "JOURNAL", "trade journal": "JOURNAL", "conference and proceedings": "CONFERENCE", "conference proceedings": "CONFERENCE", "book series": "BOOK_SERIES"},
}


def mapped(s: Column, values: dict[str, str], other: str = "OTHER") -> Column:
    """A value by a small table, other for what it doesn't list."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), s), F.lit(other))


def work_type(s: Column, source: str = "crossref") -> Column:
    """case ignored; a missing type is other."""
    return mapped(F.lower(F.coalesce(s, F.lit("other"))), WORK_TYPES if source == "crossref" else WORK_TYPES_2)


def venue_type(s: Column, source: str) -> Column:
    """the table of the source; in works the type counts as written, elsewhere case and white space are ignored."""
    return mapped(F.coalesce(s if source == "openalex-works" else F.lower(stripped(s)), F.lit("")), VENUE_TYPES[source])


def license_code(s: Column) -> Column:
    """what follows the last slash, lower case."""
    return F.lower(F.trim(F.substring_index(F.trim(s), "/", -1)))


def best_license(licenses: Column) -> Column:
    """struct of url and version of the license with the latest valid start date, ties to the first; undated ones only
    where they come first and no dated one follows. licenses: array of struct<url, version, start: array<int>>."""
    part = lambda s, k: F.coalesce(F.get(s, F.lit(k)), F.lit(1))
    valid = lambda s: F.get(s, F.lit(0)).between(1000, 9999) & part(s, 1).between(1, 12) & part(s, 2).between(1, 31)
    day = lambda s: F.when(valid(s), F.get(s, F.lit(0)) * 10000 + part(s, 1) * 100 + part(s, 2)).otherwise(0)
    some = F.filter(licenses, lambda x: x["url"] != "")
    ranked = F.transform(
        some,
        lambda x, i: F.struct(
            day(x["start"]).alias("day"), (-i).alias("place"), F.left(F.trim(x["url"]), F.lit(512)).alias("url"), F.left(F.when(F.trim(x["version"]) != "", F.trim(x["version"])), F.lit(50)).alias("version")
        ),
    )
    return let(F.array_max(ranked), lambda best: F.when(best.isNotNull(), F.struct(best["url"].alias("url"), best["version"].alias("version"))))
