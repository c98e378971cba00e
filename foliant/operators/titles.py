"""Which records are loaded, and which titles and subtitles are debris."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bound import let
from ..functions.text import filter_text
from ..ship import to_workers

# Fixed values of the ingest rules.
EXCLUDED_TYPES = (
    "review", "peer-review", "book-review", "editorial", "erratum", "errata", "correction", "corrigendum", "retraction", "addendum",
    "letter", "note", "publisher-note", "paratext", "obituary", "acknowledgments", "journal-issue",
)
EXCLUDED_TITLES = (
    "-", "--", "---", "n/a", "na", "none", "unknown", "untitled", "no title", "title unavailable", "abstract", "resumo", "resumen", "toc",
    "table of contents", "contents", "author index", "subject index", "books received", "publications received", "new books", "contributors",
    "list of contributors", "frontmatter", "front cover", "covers", "title page", "masthead", "copyright", "erratum", "abstracts", "summaries",
    "introduction", "international meetings", "annual meeting", "preface", "foreword", "avant-propos", "avant propos", "apresentacao", "presentacion",
)
TITLE_PATTERNS = (
    ("review-title", r"\b(book\s+reviews?|resenhas?|resenas?|rezensionen?|comptes?-?rendus?)\b"),
    ("editorial-title", r"\b(editorial|editorial note|editor s note|editors introduction|publisher s note|note from the editor|from the editor|letter from the editor)\b"),
    ("index-title", r"\b(author index|subject index|table of contents|index to volume|volume index|contents of volume|volume contents|author and subject indexes?|subject and author indexes?|sumario|indice)\b|\btoc\b"),
    ("front-matter-title", r"\b(front matter|back matter|cover and front matter|cover and back matter|issue information|frontmatter|front cover|title page|titelei|inhaltsverzeichnis|ficha tecnica|nota sobre a capa|paginas previas)\b"),
    ("acknowledgment-title", r"\b(acknowledg(e)?ment(s)?|agradecimento(s)?|agradecimientos)\b"),
    ("contributor-note-title", r"\b(contributors?|list of contributors|among the contributors|notes? on contributor(s)?|about the authors?|author biographies?|biographical notes?)\b"),
    ("errata-title", r"\b(correction(s)?|corrigendum|corregendum|erratum|errata|retraction|expression of concern)\b"),
    ("announcement-title", r"\b(announcement(s)?|call for applications|instructions for authors|future issues|forthcoming issues|international meetings?|annual meeting|conference announcement|conference program)\b"),
    ("conference-note-title", r"^(the )?[ivxlcdm]+(st|nd|rd|th)? international conference on\b|\bmedical sociology group annual conference\b"),
    ("books-received-title", r"\b(books?\s+received|publications?\s+received|new\s+books|publications?\s+recues|libros\s+recibidos|obras\s+recebidas)\b"),
    ("reviewer-note-title", r"\b(thanks to reviewers|reviewers? for this)\b"),
)
SUBTITLE_PATTERNS = (
    ("review-byline-publisher", r"(?:university.*press|press|publishers?|verlag).*(?:\.? by [a-z]|\.? edited by [a-z]|\. ed\. by)"),
    ("review-publisher-pages", r"(?:university.*press|press|publishers?|verlag).*\d+\s*pp"),
    ("review-price-publisher", r"[\$£€]\s*\d+\.\d{2}.*(?:press|publishers?|pp\.|isbn)"),
)

# Fixed values of the junk-title rules.
PLACEHOLDERS = (
    "-", "--", "---", "n/a", "na", "none", "unknown", "untitled", "no title", "title unavailable", "título indisponível", "título não disponível",
    "sans titre", "ohne titel", "senza titolo",
)
PUNCTUATION = ("%.%.%.%", "%,%,%.", "%.%:%", "%.%,%.%", "%.%)%.%", "%.%,%:%")
BOILERPLATE = (
    "publications received", "notes", "notes and news", "notes of the quarter", "note of the quarter", "back numbers of the journal", "rejoinder",
    "discussion", "comment", "comments", "reply", "international meetings", "annual meeting", "front matter", "back matter", "front cover", "back cover",
    "cover and front matter", "cover and back matter", "table of contents", "masthead", "impressum", "colophon", "editorial board", "conselho editorial",
    "comitê editorial", "equipo editorial", "comité de rédaction", "herausgeber", "about the authors", "notes on contributors", "notes on contributor",
    "contributors", "contributor", "contribuidores", "colaboradores", "collaborators", "author biographies", "author biography", "biographical note",
    "biographical notes", "notas sobre os colaboradores", "notas sobre los colaboradores", "miscellaneous", "recent scholarship", "recently published",
    "new publications", "back issues", "books received", "obras recebidas", "libros recibidos", "new books", "publications reçues",
    "eingegangene publikationen", "call for papers", "call for submissions", "conference announcement", "conference report", "conference program",
    "symposium announcement", "meeting report", "minutes of meeting", "agenda", "abstract", "abstracts", "resumo", "resumos", "resumen", "resúmenes",
    "résumé", "résumés", "zusammenfassung", "zusammenfassungen", "toc", "subject index", "author index", "keyword index", "contents", "sumário", "sumario",
    "índice", "indice", "índices", "indices", "contents volume", "annual index", "correspondence", "preface", "foreword", "avant-propos", "apresentação",
    "presentación", "issue information", "expediente", "table des illustrations", "the bantu treasury series", "the vilakazi prize",
    "witwatersrand university press", "un publications", "matéria de capa", "matéria final", "materias preliminares", "materias finales",
    "notice", "notices",
)
PREFIXES = (
    "list of ", "message from ", "program for ", "surveys by ", "acknowledgment", "acknowledgement", "agradecimiento", "agradecimento", "remerciement",
    "danksagung", "ringraziament", "editorial", "note from the editor", "from the editor", "carta do editor", "letter from the editor", "announcement",
    "anúncio", "anuncio", "mitteilung", "avviso", "avvisi ", "correction:", "correction to ", "corrections:", "corrections to ", "corrigendum",
    "corregendum", "errata", "erratum", "correção", "correções", "retraction:", "retraction of ", "retracted:", "expression of concern",
    "index to volume", "index for volume", "contents of volume", "issue information", "informações do fascículo", "información del número",
    "informazioni del fascicolo", "call for papers", "call for submissions", "letter to the editor", "letters to the editor", "book review:",
    "book reviews:", "book review -", "resenha:", "reseña:", "comptes rendus", "comptes-rendus", "rezension:", "rezensionen:", "reviewed by ", "review of",
    "communications, comments", "teses ", "dissertações ",
)
STRUCTURE = (
    r",\s*eds?\.?\s*$", r"\(eds?\.?\)\s*$", r",\s*[0-9]+\s*pp\.?\s*$", r",\s*[0-9]+\s*pages?\s*$", r"\bISBN[\s:\-]*[0-9Xx\-]{10,}",
    r"\b(USD|GBP|EUR|BRL|AUD|CAD|CHF)\s*[0-9]+", r"[\$£€]\s*[0-9]+\.[0-9]{2}",
)
#: Groups of patterns that must all be found, and the length in bytes to exceed.
CITATIONS = (
    ((r"(University.*Press|Press|Publishers?|Verlag|\. Pp\.|, pp\.|ISBN|\$[0-9]+|£[0-9]+|\(cloth\)|\(paper\))", r"\. By [A-Z]|\. Edited by [A-Z]|\. Ed\. by| By [A-Z].*Press"), 0),
    ((r"(University.*Press|\. Pp\.|, pp\.|[0-9]+ pp|ISBN)",), 50),
    ((r"(Press|Publishers?|Books?).*[0-9]{4}", r"[0-9]+\s*pp"), 40),
    ((r"[\$£€]\s*[0-9]+\.[0-9]{2}", r"(Press|Publishers?|pp\.|ISBN)"), 0),
)


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _base_letters() -> tuple[str, str]:
    """Lower-case Latin letters with marks and the letters that they are read as, by decomposition."""
    pairs = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, [*range(0xE0, 0x250), *range(0x1E00, 0x1F00)])]
    pairs = [(c, b) for c, b in pairs if c != b and c == c.lower()]
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _BASE = _base_letters()


def folded(s: Column) -> Column:
    """Lower case without the marks of Latin letters: equal where an accent- and case-insensitive collation has it so."""
    return F.translate(F.regexp_replace(F.lower(s), "[\u0300-\u036f]", ""), _MARKED, _BASE)


def fold(s: str) -> str:
    """folded() of a literal."""
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


def exclusion_reason(title: Column, work_type: Column, source: str = "unknown", subtitle: Column | None = None) -> Column:
    """Why a record is not loaded, NULL if it is; the first rule that holds names the reason.

    The type is normalised like the title, so types with a hyphen match no entry.
    """

    def say(what, value=None):
        return F.concat(F.lit(f"{source}:{what}"), value) if value is not None else F.lit(f"{source}:{what}")

    def ruled(said):
        kind, name = said["kind"], said["name"]
        rules = [F.when(kind.isin(*EXCLUDED_TYPES), say("work_type=", kind)), F.when(name == "", say("blank_title")), F.when(name.isin(*EXCLUDED_TITLES), say("title_exact=", name))]
        return F.coalesce(*rules, *[F.when(name.rlike(p), say(f"title_pattern={label}")) for label, p in TITLE_PATTERNS])

    # Both are filtered once: each rule would do it anew.
    reason = let(F.struct(F.coalesce(filter_text(work_type), F.lit("")).alias("kind"), F.coalesce(filter_text(title), F.lit("")).alias("name")), ruled)
    if subtitle is None:
        return reason
    return F.coalesce(reason, *[F.when((F.length(subtitle) > 40) & subtitle.rlike(f"(?i){p}"), say(f"subtitle_pattern={label}")) for label, p in SUBTITLE_PATTERNS])


def ingest(records: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected with `reason`) of records with title, work_type, subtitle; no title at all is missing-title."""
    to_workers(records.sparkSession)
    reason = exclusion_reason(F.col("title"), F.col("work_type"), source, F.col("subtitle"))
    judged = records.withColumn("reason", F.when(F.col("title").isNull(), F.lit(f"{source}:missing-title")).otherwise(reason))
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def raw_type_allowed(work_type: Column) -> Column:
    """Types as they are written, hyphens and all; a missing type is allowed."""
    return F.coalesce(~work_type.isin(*EXCLUDED_TYPES), F.lit(True))


def blank(title: Column) -> Column:
    """P11."""
    return F.trim(F.coalesce(title, F.lit(""))) == ""


def junk_title(title: Column) -> Column:
    """P4 to P8 as the name of the first rule that holds: placeholder, punctuation, boilerplate, prefix, structure; NULL for a title."""
    t, bare = folded(title), folded(F.trim(title))
    prefix = "^(?:" + "|".join(sorted({re.escape(fold(p)) for p in PREFIXES})) + ")"
    return F.coalesce(
        F.when(blank(title) | bare.isin(*map(fold, PLACEHOLDERS)), "placeholder"),
        F.when(_any(title.like(p) for p in PUNCTUATION), "punctuation"),
        F.when(bare.isin(*map(fold, BOILERPLATE)), "boilerplate"),
        F.when(t.rlike(prefix), "prefix"),
        F.when(_any(title.rlike(f"(?i){p}") for p in STRUCTURE), "structure"),
    )


def cites_a_review(subtitle: Column, work_type: Column) -> Column:
    """Articles and chapters whose subtitle is the citation of a reviewed book."""

    def holds(patterns, least):
        found = reduce(lambda a, b: a & b, [subtitle.rlike(f"(?i){p}") for p in patterns])
        return found & (F.octet_length(subtitle) > least)

    return F.coalesce(_any(holds(*c) for c in CITATIONS) & work_type.isin("ARTICLE", "CHAPTER"), F.lit(False))


def mode_gate(incoming: DataFrame, existing: DataFrame, key: str, mode: str) -> DataFrame:
    """P10: new and fast take keys that are not stored; update those that are, and rows without a key; full all."""
    stored = existing.select(key).where(F.col(key).isNotNull()).distinct()
    if mode in ("new", "fast"):
        return incoming.join(stored, key, "left_anti")
    if mode == "update":
        marked = incoming.join(stored.withColumn("__stored", F.lit(True)), key, "left")
        return marked.where(F.col("__stored") | F.col(key).isNull()).drop("__stored")
    if mode != "full":
        raise ValueError(f"mode {mode!r} is none of new, fast, update, full")
    return incoming
