"""Text, name and term functions as native expressions; full Unicode normalisation by vectorised UDFs."""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .bound import let


def nothing_if_blank(s: Column) -> Column:
    return F.when(F.trim(s) != "", s)


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape(s: Column) -> Column:
    """all HTML entities; only texts that can hold one are sent to Python."""
    some = s.contains("&")
    return F.when(some, _unescaped(F.when(some, s))).otherwise(s)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@lru_cache(maxsize=None)
def _marks() -> re.Pattern:
    """Runs of combining characters; a text is searched for them as a whole, not asked letter by letter."""
    codes = [k for k in range(sys.maxunicode + 1) if unicodedata.combining(chr(k))]
    return re.compile("[" + "".join(re.escape(chr(k)) for k in codes) + "]+")


@F.pandas_udf(StringType())
def without_marks(s: pd.Series) -> pd.Series:
    marks = _marks()
    return s.map(lambda x: x if x.isascii() else marks.sub("", unicodedata.normalize("NFKD", x)), na_action="ignore")


def collapse(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), r"^ | $", "")


def person_key(s: Column) -> Column:
    """what names are matched by; NULL under two characters."""
    k = F.regexp_replace(F.lower(s), "[‎‏​.,\"`()]", "")
    k = collapse(k)
    return F.when(F.length(k) >= 2, k)


def name_without_stops(s: Column) -> Column:
    """F22."""
    return collapse(F.regexp_replace(s, "[.,;]+", " "))


#: Fixed value: the marks that separate words in a term.
TERM_MARKS = r"[-_/,:;.'\"`()\[\]&|]+"


def term_key(s: Column) -> Column:
    """lower case, runs of the term marks as one space; other symbols stay."""
    return F.coalesce(collapse(F.regexp_replace(F.lower(s), TERM_MARKS, " ")), F.lit(""))


def ingest_text(s: Column) -> Column:
    """entities first, then tags."""
    return nothing_if_blank(collapse(F.regexp_replace(unescape(s), "<[^>]+>", " ")))


#: Fixed value: control and invisible characters that become spaces.
INVISIBLE = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\u200B-\u200F\u202A-\u202E\u2060\uFEFF\uFFFD]"


def cleaned_text(s: Column) -> Column:
    """tags first, then entities, compatibility forms, control characters and the edges."""
    s = nfkc(unescape(F.regexp_replace(s, "<[^>]+>", " ")))
    return trimmed_edges(collapse(F.regexp_replace(s, INVISIBLE, " ")))


def trimmed_edges(s: Column) -> Column:
    """punctuation that isn't a bracket or quote goes at both ends."""
    edge = r"[\s\p{Cc}\p{Cf}\p{Po}\p{Pd}\p{Pc}|·•…&&[^\"'¿¡]]+"
    return F.regexp_replace(s, rf"^{edge}|{edge}$", "")


def filter_text(s: Column) -> Column:
    """ASCII letters, digits and single spaces."""
    return F.regexp_replace(F.regexp_replace(F.lower(without_marks(s)), "[^a-z0-9]+", " "), "^ | $", "")


def entities_in_place(s: Column) -> Column:
    """the two entities that the SQL step knows, where any entity occurs."""
    new = F.trim(F.replace(F.replace(s, F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" ")))
    return F.when(s.rlike("&[a-zA-Z0-9#]+;"), new).otherwise(s)


def abstract_of_jats(s: Column) -> Column:
    """whole sections go, then F25."""
    return F.left(ingest_text(F.regexp_replace(s, r"(?s)<jats:sec\b.*?</jats:sec>", " ")), F.lit(16777215))


def abstract_of_index(index: Column) -> Column:
    """the text of an inverted index (word to positions); gaps stay empty, the last word of a place wins. Sorted once, so its work grows with the text."""
    words = F.map_entries(index)
    pairs = F.flatten(F.transform(words, lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))))

    def joined(s):
        last = F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["p"] != x["p"], F.lit(True)))
        gap = lambda at, x, k: x["p"] - F.coalesce(F.when(k > 0, F.get(at, k - 1)["p"]), F.lit(-1)) - 1
        filled = lambda at: F.transform(at, lambda x, k: F.concat(F.repeat(F.lit(" "), gap(at, x, k)), x["w"]))
        return let(last, lambda at: F.array_join(filled(at), " "))

    return let(F.array_sort(F.filter(pairs, lambda x: x["p"] >= 0)), lambda s: F.when(F.size(s) > 0, joined(s)))


def title_from_letters(s: Column) -> Column:
    """F36."""
    return F.regexp_replace(s, r"^[^\p{L}]+", "")


def dots_to_ellipsis(s: Column) -> Column:
    """F37."""
    return F.replace(s, F.lit("..."), F.lit("…"))


#: Small letters whose capital upper() spells with several, and the one letter that is their capital.
LONG_CAPITALS = ("ßᾀᾁᾂᾃᾄᾅᾆᾇᾐᾑᾒᾓᾔᾕᾖᾗᾠᾡᾢᾣᾤᾥᾦᾧᾳῃῳ", "ẞᾈᾉᾊᾋᾌᾍᾎᾏᾘᾙᾚᾛᾜᾝᾞᾟᾨᾩᾪᾫᾬᾭᾮᾯᾼῌῼ")


def upper_first(s: Column) -> Column:
    """a letter becomes one letter; one without such a capital stays."""
    small = F.left(s, F.lit(1))
    capital = F.when(F.length(F.upper(small)) == 1, F.upper(small)).otherwise(F.translate(small, *LONG_CAPITALS))
    return F.when(s.rlike(r"^\p{Ll}"), F.concat(capital, F.substring(s, F.lit(2), F.length(s)))).otherwise(s)


def split_title(title: Column, subtitle: Column) -> Column:
    """struct of title and subtitle, split at the first colon where there is no subtitle yet."""
    head, tail = F.trim(F.substring_index(title, ":", 1)), F.trim(F.regexp_replace(title, "^[^:]*:", ""))
    fits = subtitle.isNull() & title.contains(":") & (head != "") & (tail != "")
    return F.when(fits, F.struct(head.alias("title"), upper_first(tail).alias("subtitle"))).otherwise(F.struct(title.alias("title"), subtitle.alias("subtitle")))


def _letters(s: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(s, rf"[^\p{{{kind}}}]", ""))


def all_upper(s: Column) -> Column:
    """four letters or more, of which four in five are capitals."""
    return (_letters(s, "L") >= 4) & (_letters(s, "Lu") * 5 >= _letters(s, "L") * 4)


def all_lower(s: Column) -> Column:
    return (_letters(s, "L") >= 4) & (_letters(s, "Ll") == _letters(s, "L"))


def sentinel_to_null(s: Column, words: tuple[str, ...]) -> Column:
    """NULL for values that only say that there is none; the two stages have different words."""
    return F.when(~F.lower(F.trim(s)).isin(*words), s)


#: Fixed values of the two stages.
NONE_AT_CLEANUP = ("none", "null", "n/a", "na", "[no title available]", "no title available", "title unavailable")
NONE_IN_SQL = ("none", "null", "nan", "")


def stripped(s: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def _of_commas(raw: Column) -> Column:
    """struct(surname, given) of `surname, given, ...`: the first part and the rest; one part stands for both; NULL without any."""
    def of(parts):
        first, rest = F.get(parts, F.lit(0)), F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), " ")
        return F.when(F.size(parts) > 0, F.struct(first.alias("surname"), F.when(F.size(parts) > 1, rest).otherwise(first).alias("given")))

    return let(F.filter(F.transform(F.split(raw, ","), stripped), lambda x: x != ""), of)


def person_name(family: Column, given: Column, display: Column) -> Column:
    """struct of given, surname and preferred.

    A comma in family or given name splits both together; without either, the display name is split at its comma or
    before its last word. A part that is missing is filled from the other. Marks go last, then the lengths are cut.
    """
    none = lambda c: F.when(c != "", c)
    clean = lambda c: none(name_without_stops(c))
    pair = lambda surname, first: F.struct(surname.alias("surname"), first.alias("given"))

    def by_comma(p):
        comma = F.coalesce(p["family"].contains(","), F.lit(False)) | F.coalesce(p["given"].contains(","), F.lit(False))
        return F.coalesce(F.when(comma, _of_commas(F.concat_ws(" ", p["given"], p["family"]))), pair(p["family"], p["given"]))

    def shown(name):
        words = F.split(name, " ")
        by_space = pair(F.element_at(words, -1), F.when(F.size(words) > 1, F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " ")).otherwise(name))
        return F.coalesce(F.when(name.contains(","), _of_commas(name)), by_space)

    def named(p):
        return F.when(p["surname"].isNull() & p["given"].isNull() & none(display).isNotNull(), let(stripped(display), shown)).otherwise(p)

    def filled(p):
        surname, first = none(p["surname"]), none(p["given"])
        return pair(clean(F.coalesce(surname, first)), clean(F.coalesce(first, surname)))

    def cut(p):
        preferred = none(F.left(F.concat_ws(" ", p["given"], p["surname"]), F.lit(255)))
        return F.struct(F.left(p["given"], F.lit(255)).alias("given"), F.left(p["surname"], F.lit(100)).alias("surname"), preferred.alias("preferred"))

    start = F.struct(none(family).alias("family"), none(given).alias("given"))
    return let(start, lambda p: let(by_comma(p), lambda q: let(named(q), lambda r: let(filled(r), cut))))


def display_name(given: Column, family: Column) -> Column:
    """given and family name, NULL if neither says anything."""
    part = lambda c: F.when(stripped(c) != "", stripped(c))
    shown = F.concat_ws(" ", part(given), part(family))
    return F.when(shown != "", shown)


#: Suffixes of which one is dropped; particles of two words, tried before those of one; what separates words.
SUFFIXES = "NETO NETA SOBRINHO SOBRINHA BISNETO BISNETA TERCEIRO TERCEIRA SR SRA II III IV V VI VII VIII IX X".split()
TWO_WORDS = ("VAN DER", "VAN DEN", "VAN DE", "VON DER", "VON DEM", "DE LA", "DE LOS", "DE LAS", "DE LO")
PARTICLES = (
    "DO DA DOS DAS DE DEL DELA DELLA DELLE DELLO DEGLI DI DU DES VAN VON AL EL LA LE LES LO LOS LAS SAINT SAINTE SAN SANTA SANTO "
    "MC MAC BEN BIN IBN AB AP AUF ZU ZUM ZUR TER TEN"
).split()
NAME_MARKS = "[.,()\"'\u2010\u2212\u2013\u2014/\\[\\]{}#@!?;:\u00b0\u00aa\u00ba&~`^_+=|<>]"


def signature(name: Column) -> Column:
    """the surname with its particle, and the initials of the rest, each a word; NULL for a single letter or nothing."""
    s = F.trim(F.regexp_replace(F.upper(name), NAME_MARKS, " "))
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)([^\p{Alpha}])-", "$1 "), r"(?U)-([^\p{Alpha}])", " $1")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "^-|-$", ""), r"(?U)\s+", " "))
    s = F.trim(F.regexp_replace(s, rf"(?U)\s+(?:{'|'.join(SUFFIXES)})$", ""))

    def of(s):
        last = lambda words: F.regexp_substr(s, F.lit(rf"(?U)\b(?:{'|'.join(words)})\s+[^\s]+$"))
        surname = F.coalesce(last(TWO_WORDS), last(PARTICLES), F.regexp_substr(s, F.lit(r"(?U)[^\s]+$")))

        def whole(surname):
            rest = F.trim(F.left(s, F.length(s) - F.length(surname)))
            initials = F.trim(F.regexp_replace(rest, r"(?U)\b(\p{Alpha})[^\s]*\s*", "$1 "))
            return F.trim(F.when(rest != "", F.concat_ws(" ", surname, initials)).otherwise(surname))

        return F.when(s.contains(" "), let(surname, whole)).when(F.length(s) > 1, s)

    return let(s, of)


#: Particles and suffixes of the family name in the repair of names; these differ from the signature's.
_FAMILY_PARTICLES = ("do", "da", "dos", "das", "de", "del", "della", "di", "du", "van der", "van", "von der", "von", "al", "el", "la", "le", "saint", "sainte", "mc", "mac", "o")
_FAMILY_SUFFIXES = ("filho", "junior", "neto", "sobrinho", "jr", "sr", "iii", "iv", "v")


def family_and_given(preferred: Column) -> Column:
    """struct of family_name and given_names of a preferred name: the last word with its particles and a suffix, and the rest.

    Cut by characters, so that letters of several bytes shift nothing.
    """
    name = F.trim(preferred)
    family = F.regexp_substr(name, F.lit(rf"(?iU)(?:\b(?:{'|'.join(_FAMILY_PARTICLES)})\s+)*[^\s]+(?:\s+(?:{'|'.join(_FAMILY_SUFFIXES)}))?$"))
    rest = F.trim(F.left(name, F.length(name) - F.length(family)))
    several = name.contains(" ")
    return F.when(
        preferred.isNotNull(),
        F.struct(F.when(several, family).otherwise(name).alias("family_name"), F.when(several & (rest != ""), rest).alias("given_names")),
    )


def renamed(preferred: Column, wrong: str, right: str) -> Column:
    """a preferred name whose last word or words are wrong (without regard to case and accents) ends in right instead."""
    ends = same_letters(F.right(preferred, F.lit(len(wrong) + 1))) == same_letters(F.lit(f" {wrong}"))
    return F.when(ends, F.concat(F.left(preferred, F.length(preferred) - len(wrong)), F.lit(right))).otherwise(preferred)


def same_letters(s: Column) -> Column:
    """Case- and accent-insensitive key with trailing spaces ignored, as the tables' collation compares."""
    return F.collate(s, "UNICODE_CI_AI_RTRIM")


def first_text(values: Column) -> Column:
    """the first of a list of texts, NULL for an empty one; a single text is a list of one."""
    return F.get(values, F.lit(0))


def blank_title(values: Column) -> Column:
    """F32 over a list: whether its first title is missing or blank."""
    return stripped(F.coalesce(first_text(values), F.lit(""))) == ""


#: What an abstract may begin with, by stage.
ABSTRACT_WORDS = ("abstract", "resumo", "resumen")
ABSTRACT_WORDS_SQL = ("abstract", "resumen", "resumo", "résumé", "zusammenfassung", "sommario", "riassunto")


def abstract_cleaned(s: Column) -> Column:
    """F26 with F35 of the cleanup stage: the prefix goes after the text has been cleaned, then the edges again."""
    return trimmed_edges(stripped(F.regexp_replace(cleaned_text(s), rf"(?i)^(?:{'|'.join(ABSTRACT_WORDS)})(?U)\s*[:\-–—]*\s*", "")))


def abstract_without_prefix(s: Column) -> Column:
    """F35 of the SQL stage, in its three passes: the word, what it leaves at the start, NULL for what is then empty."""
    one = F.trim(F.regexp_replace(s, rf"(?iu)^(?:{'|'.join(ABSTRACT_WORDS_SQL)})\s*:?\s*", ""))
    one = F.when(s.rlike(rf"(?iu)^(?:{'|'.join(ABSTRACT_WORDS_SQL)})"), one).otherwise(s)
    two = F.when(one.rlike(r"^[\s:\-–—]"), F.trim(F.regexp_replace(one, r"^[\s:\-–—]+", ""))).otherwise(one)
    return F.when(F.trim(two) != "", two)


def clean_string(s: Column, most: int | None = None) -> Column:
    """stripped and cut, NULL if nothing is left."""
    out = F.when(stripped(s.cast("string")) != "", stripped(s.cast("string")))
    return F.left(out, F.lit(most)) if most else out


def whole_number(s: Column) -> Column:
    """an integer, NULL for what isn't one."""
    t = stripped(s.cast("string"))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))


#: Roles of contributors, by the field that they come in.
ROLES = {"author": "AUTHOR", "editor": "EDITOR", "translator": "TRANSLATOR", "reviewer": "REVIEWER"}


def role(s: Column) -> Column:
    """one of the four roles, NULL for any other."""
    key = F.lower(stripped(s))
    return F.when(key.isin(*ROLES), F.upper(key))


def kept_if_shrunk(old: Column, new: Column) -> Column:
    """the new value, but the old one where it is empty or, of a text of 20 characters or more, under a hundredth of it."""
    tiny = (F.length(old) >= 20) & (F.length(new) * 100 < F.length(old))
    return F.when((new == "") | tiny, old).otherwise(new)
