"""Identifier normalisers. Variants that differ by stage (load or transform) are kept apart on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import nothing_if_blank, stripped, unescape


def _bare_doi(s: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)^\s+|\s+$", ""), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:)", "")
    s = F.regexp_replace(s, r"(?U)\s+", "")
    s = F.regexp_replace(s, "^[\"']+|[\"']+$", "")
    return F.lower(F.regexp_replace(s, r"[.,;:]+$", ""))


def doi_at_load(s: Column) -> Column:
    """the bare lower-case DOI, NULL unless it looks like one."""
    d = _bare_doi(F.when(s.contains("&"), unescape(s)).otherwise(s))
    return F.when(d.rlike(r"^10\.\S+/\S+$"), d)


def doi_at_transform(s: Column) -> Column:
    """as F1 without entities and without the check of the shape."""
    return _bare_doi(s)


def doi_of_work(s: Column) -> Column:
    """lower case without the resolver's address."""
    return F.regexp_replace(F.lower(s), r"^https?://doi\.org/", "")


def issn(s: Column) -> Column:
    """XXXX-XXXX or NULL."""
    c = F.upper(F.regexp_replace(s, r"[\s-]", ""))
    return F.when(c.rlike("^[0-9X]{8}$"), F.concat_ws("-", F.left(c, F.lit(4)), F.right(c, F.lit(4))))


def issn_cleaned(s: Column) -> Column:
    """XXXX-XXXX where eight characters are left, else the trimmed original."""
    c = F.upper(F.regexp_replace(s, "[^0-9Xx]", ""))
    return F.when(F.length(c) == 8, F.concat_ws("-", F.left(c, F.lit(4)), F.right(c, F.lit(4)))).otherwise(F.trim(s))


def lookup_issn(print_: Column, electronic: Column) -> Column:
    """struct of the key and which of the two it is."""
    pair = lambda c, name: F.when(issn(c).isNotNull(), F.struct(issn(c).alias("key"), F.lit(name).alias("kind")))
    return F.coalesce(pair(print_, "issn"), pair(electronic, "eissn"))


def orcid_cleaned(s: Column) -> Column:
    """upper case without the address; sixteen characters get their hyphens."""
    u = F.upper(F.regexp_replace(F.trim(s), r"(?i)^https?://(?:www\.)?orcid\.org/", ""))
    c = F.regexp_replace(u, "[^0-9X]", "")
    return F.when(F.length(c) == 16, F.regexp_replace(c, "^(.{4})(.{4})(.{4})(.{4})$", "$1-$2-$3-$4")).otherwise(u)


def orcid_found(s: Column) -> Column:
    """F8: the first ORCID in a text, or NULL."""
    return F.upper(F.regexp_substr(s, F.lit(r"\d{4}-\d{4}-\d{4}-\d{3}[\dXx]")))


def isbn(s: Column) -> Column:
    """F9."""
    return F.upper(F.regexp_replace(s, r"(?U)\s", ""))


def isbn_first(s: Column) -> Column:
    """the first of a list, without hyphens, 20 characters."""
    return F.left(F.replace(F.substring_index(s, ",", 1), F.lit("-"), F.lit("")), F.lit(20))


def last_segment(s: Column, most: int = 50) -> Column:
    """what follows the last slash, a trailing one aside."""
    return F.left(nothing_if_blank(F.substring_index(F.regexp_replace(s, "/+$", ""), "/", -1)), F.lit(most))


def ror_id(s: Column) -> Column:
    """what follows the last slash, 20 characters."""
    return last_segment(stripped(s), 20)


def mag_id(s: Column) -> Column:
    """a number or text; of a number with a fraction the whole part."""
    return last_segment(stripped(F.regexp_replace(s.cast("string"), r"^(\d+)\.\d*$", "$1")))


def arxiv_id(s: Column) -> Column:
    """F16: what follows the last slash of an address, else the value as it is, 30 characters."""
    return F.left(F.when(s.contains("arxiv.org/"), F.substring_index(s, "/", -1)).otherwise(F.when(s != "", s)), F.lit(30))


def wikidata_id(s: Column) -> Column:
    """F13."""
    return F.left(F.coalesce(F.regexp_substr(s, F.lit(r"Q\d+")), F.trim(s)), F.lit(20))


def pmid(s: Column) -> Column:
    """F16."""
    return F.regexp_substr(s, F.lit(r"\d{5,12}"))


def pmcid(s: Column) -> Column:
    """F16: PMC and digits, which may stand bare."""
    found = F.upper(F.regexp_substr(s, F.lit(r"(?i)PMC\d+")))
    return F.coalesce(found, F.when(F.trim(s).rlike(r"^\d{1,15}$"), F.concat(F.lit("PMC"), F.trim(s))))


def file_stem(doi: Column) -> Column:
    """K2: the file name of a DOI."""
    return F.translate(doi, "/:", "__")


def doi_of_file(path: Column) -> Column:
    """the DOI that a file name stands for: it starts with 10. and its first underscore is a slash."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.json$", "")
    doi = F.regexp_replace(stem, "^([^_]*)_", "$1/")
    return F.when(stem.startswith("10.") & doi.contains("/"), doi)


def query_value(url: Column, key: str) -> Column:
    """a value of a URL's query, NULL for a broken one."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(key))


def scielo_pid(resource: Column, links: Column) -> Column:
    """the pid of the resource's address, or else of the first link that has one; only of addresses that name scielo."""

    def of(url):
        place = F.concat_ws("", F.try_parse_url(url, F.lit("HOST")), F.try_parse_url(url, F.lit("PATH")))
        return F.when(place.contains("scielo"), F.left(nothing_if_blank(F.trim(query_value(url, "pid"))), F.lit(50)))

    return F.coalesce(of(resource), F.get(F.filter(F.transform(links, of), lambda x: x.isNotNull()), F.lit(0)))


def issn_of_links(links: Column) -> Column:
    """the ISSN in the first of these addresses that asks for one."""
    found = F.filter(F.transform(links, lambda u: query_value(u, "issn")), lambda x: x.isNotNull())
    return issn(F.get(found, F.lit(0)))


def issn_pair(s: Column) -> Column:
    """struct of issn and eissn, the first two valid ones of a list by commas."""
    found = F.filter(F.transform(F.split(F.replace(s, F.lit('"'), F.lit("")), ","), issn), lambda x: x.isNotNull())
    return F.struct(F.get(found, F.lit(0)).alias("issn"), F.get(found, F.lit(1)).alias("eissn"))


def entity_of_file(name: Column) -> Column:
    """what a list's file name is about: the name in its brackets, marks that file systems refuse as _, or else an ISSN."""
    inside = F.regexp_extract(name, r"(?:venue|author|OA_works_)\((.+?)\)\.txt$", 1)
    number = F.regexp_extract(name, r"issn_([\dXx-]+)_missing\.txt$", 1)
    return F.when(inside != "", F.regexp_replace(inside, r'[<>:"/\\|?*]', "_")).when(number != "", number)


def venue_of_file(path: Column) -> Column:
    """The venue id that a file is named after, NULL for another name."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    return F.when(stem.rlike("^[0-9]+$"), stem.try_cast("long"))
