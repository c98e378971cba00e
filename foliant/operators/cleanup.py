"""Clean-up of stored tables: entities, publication data, orphans, text phases, the quality profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers, text, values
from ..functions.places import title_case
from ..scratch import Scratch
from .integrity import without_orphans
from .keys import skip_on_conflict

Catalog = dict[str, DataFrame]

#: Columns with entities to clean; columns whose words for nothing become NULL.
ENTITY_COLUMNS = {"works": ("title", "abstract"), "organizations": ("name",), "venues": ("name",), "persons": ("preferred_name",)}
SENTINEL_COLUMNS = ("pmid", "pmcid", "isbn", "asin", "udc", "lbc", "ddc", "lcc", "google_book_id", "volume", "issue", "pages")
#: Columns of a table that no two rows may share, with the columns within which that holds.
UNIQUE = {("organizations", "name"): ("type",), ("venues", "name"): ("type",), ("persons", "preferred_name"): ()}


def _changed(df: DataFrame, table: str, column: str, new: Column) -> DataFrame:
    """df with a new value for column; where that column is a key, a value that another row holds is not taken."""
    if (table, column) not in UNIQUE or "id" not in df.columns:
        return df.withColumn(column, new)
    within = [c for c in UNIQUE[table, column] if c in df.columns]
    return skip_on_conflict(df, column, new, "id", within).drop("skipped")


def html_entities(catalog: Catalog) -> Catalog:
    """The entities that the SQL step knows, in titles, abstracts and names."""
    out = dict(catalog)
    for table, columns in ENTITY_COLUMNS.items():
        for column in columns:
            if table in out and column in out[table].columns:
                out[table] = _changed(out[table], table, column, text.entities_in_place(F.col(column)))
    return out


def publication_data(pubs: DataFrame) -> DataFrame:
    """R2: words for nothing become NULL, then volumes and issues that are DOIs, ISBN lists, page marks and blanks."""
    has = lambda *names: [c for c in names if c in pubs.columns]
    rows = pubs.withColumns({c: F.when(~F.lower(F.rtrim(F.col(c))).isin(*text.NONE_IN_SQL), F.col(c)) for c in has(*SENTINEL_COLUMNS)})
    rows = rows.withColumns({c: values.not_a_doi(F.col(c)) for c in has("volume", "issue")})
    isbn = F.col("isbn")
    rows = rows.withColumns({c: F.when(isbn.contains("-") | isbn.contains(","), identifiers.isbn_first(isbn)).otherwise(isbn) for c in has("isbn")})
    return rows.withColumns({c: values.pages_cleaned(F.col(c)) for c in has("pages")})


#: Child table, its column, the parent table (R4), in order.
CORE_ORPHANS = (
    ("authorships", "work_id", "works"), ("authorships", "person_id", "persons"), ("publications", "work_id", "works"),
    ("course_bibliography", "work_id", "works"), ("funding", "work_id", "works"), ("work_references", "citing_work_id", "works"),
)


def core_data(catalog: Catalog) -> Catalog:
    """Children without their parent go, then persons that neither wrote nor teach anything. Missing tables are empty ones.

    Only the keys of children meet their parents; what they lack, mostly little or nothing, is written down, so that the children themselves need not be shuffled.
    """
    out, scratch = dict(catalog), None
    for child, column, parent in CORE_ORPHANS:
        if child in out and parent in out:
            scratch = scratch or Scratch(out[child].sparkSession, "orphans")
            keys = out[child].select(column).where(F.col(column).isNotNull()).distinct()
            lost = scratch.write(keys.join(out[parent].select(F.col("id").alias(column)), column, "left_anti"), f"{child}-{column}")
            out[child] = out[child].where(F.col(column).isNotNull()).join(lost, column, "left_anti").select(*out[child].columns)
    uses = [(out[t], "person_id") for t in ("authorships", "course_instructors") if t in out]
    if "persons" in out and uses:
        out["persons"] = without_orphans(out["persons"], "id", *uses).select(*out["persons"].columns)
    return out


#: Parent table and the (child, column) of which one must name it (J7), in order.
MORE_ORPHANS = (
    ("works", (("authorships", "work_id"),)),
    ("venues", (("publications", "venue_id"),)),
    ("subjects", (("work_subjects", "subject_id"), ("venue_subjects", "subject_id"))),
    ("organizations", (("authorships", "affiliation_id"), ("funding", "funder_id"), ("programs", "institution_id"), ("publications", "publisher_id"), ("venues", "publisher_id"))),
)


def orphans(catalog: Catalog) -> Catalog:
    """Works without authorship, files without publication, then venues, subjects and organisations that nothing names."""
    out = dict(catalog)

    def keep(parent, children):
        uses = [(out[c], k) for c, k in children if c in out]
        if parent in out and uses:
            out[parent] = without_orphans(out[parent], "id", *uses).select(*out[parent].columns)

    keep(*MORE_ORPHANS[0])
    if "files" in out and "publications" in out:
        ids = out["publications"].select(F.col("id").alias("publication_id")).distinct()
        out["files"] = out["files"].join(ids, "publication_id", "left_semi").select(*catalog["files"].columns)
    for parent, children in MORE_ORPHANS[1:]:
        keep(parent, children)
    return out


def without_doi_twins(references: DataFrame) -> DataFrame:
    """References whose DOI, once normalised, another row of the same work already has, case aside, are deleted.

    Only DOIs that end in a mark or hold a space are looked at, as only those change beyond their case.
    """
    key = lambda c: F.lower(F.rtrim(c))
    odd = F.col("cited_doi").rlike(r"[.,;:]+$") | F.col("cited_doi").contains(" ")
    new = identifiers.doi_at_transform(F.col("cited_doi"))
    candidates = references.where(odd).where(new != F.col("cited_doi")).select("id", "citing_work_id", new.alias("twin"))
    stored = references.select(F.col("citing_work_id"), key(F.col("cited_doi")).alias("twin"), F.col("id").alias("other"))
    gone = candidates.join(stored, ["citing_work_id", "twin"]).where("other <> id").select("id").distinct()
    return references.join(gone, "id", "left_anti").select(*references.columns)


#: Columns that the identifier phase normalises, in order.
IDENTIFIERS: tuple[tuple[str, str, Callable[[Column], Column]], ...] = (
    ("publications", "doi", identifiers.doi_at_transform), ("work_references", "cited_doi", identifiers.doi_at_transform), ("persons", "orcid", identifiers.orcid_cleaned),
    ("venues", "issn", identifiers.issn_cleaned), ("venues", "eissn", identifiers.issn_cleaned), ("publications", "isbn", identifiers.isbn),
)


def identifier_phase(catalog: Catalog) -> Catalog:
    """Identifiers in their normal form; a value that another row holds is not taken, an empty one neither."""
    out = dict(catalog)
    for table, column, f in IDENTIFIERS:
        if table not in out or column not in out[table].columns:
            continue
        if table == "work_references":
            out[table] = without_doi_twins(out[table])
        new = F.when(f(F.col(column)) != "", f(F.col(column))).otherwise(F.col(column))
        within = ["citing_work_id"] if table == "work_references" else []
        free = column == "isbn"
        out[table] = out[table].withColumn(column, new) if free else skip_on_conflict(out[table], column, new, "id", within).drop("skipped").select(*out[table].columns)
    return out


#: What the text phases leave alone.
EXCLUDED_TABLES = ("summary_publications", "summary_venues", "summary_persons", "subject_relevance_tiers", "venue_ranking_rules", "subject_stoplist")
EXCLUDED_COLUMNS = (
    "id doi isbn issn eissn orcid ror_id scopus_id lattes_id license_url file_hash md5 title_normalized term_key sha1 sha256"
).split()


def text_columns(df: DataFrame, table: str, keys: tuple[str, ...] = ("id",)) -> list[str]:
    """The text columns of a table that clean-up may change."""
    if table in EXCLUDED_TABLES:
        return []
    return [c for c, kind in df.dtypes if kind == "string" and c not in EXCLUDED_COLUMNS and c not in keys]


def text_phase(catalog: Catalog) -> Catalog:
    """Text cleaned in every such column, unless it would vanish or shrink to almost nothing."""
    out = dict(catalog)
    for table, df in catalog.items():
        for column in text_columns(df, table):
            clean = text.abstract_cleaned if (table, column) == ("works", "abstract") else text.cleaned_text
            out[table] = _changed(out[table], table, column, text.kept_if_shrunk(F.col(column), clean(F.col(column))))
        out[table] = out[table].select(*df.columns)
    return out


def sentinel_phase(catalog: Catalog) -> Catalog:
    """Words for nothing become NULL in every such column."""
    out = dict(catalog)
    for table, df in catalog.items():
        for column in text_columns(df, table):
            out[table] = out[table].withColumn(column, text.sentinel_to_null(F.col(column), text.NONE_AT_CLEANUP))
    return out


def capitalization_phase(catalog: Catalog) -> Catalog:
    """Titles in capitals or small letters throughout get a title's, then every first letter is a capital."""
    works = catalog["works"]
    for column in ("title", "subtitle"):
        c = F.col(column)
        if column in works.columns:
            fixed = F.when(text.all_upper(F.trim(c)) | text.all_lower(F.trim(c)), title_case(F.trim(c))).otherwise(c)
            works = works.withColumn(column, text.upper_first(fixed))
    return catalog | {"works": works}


def profile(catalog: Catalog) -> DataFrame:
    """(label, n) of the sixteen quality signals, from one pass over each table; missing columns count nothing."""
    edge = r"^[\s\p{Punct}]+"
    html, prefix = "<[^>]+>", r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:)"
    same = lambda c, f, n: (c == f(c)) & (c != "") & (F.length(c) > n)
    none = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("none", "null", "n/a", "na")
    c = F.col
    signals = {
        "works": {
            "works.title leading punct": (["title"], c("title").rlike(edge)), "works.abstract html": (["abstract"], c("abstract").rlike(html)),
            "works.title with : and no subtitle": (["title", "subtitle"], c("title").contains(":") & c("subtitle").isNull()),
            "works.title ALL CAPS": (["title"], same(c("title"), F.upper, 3)), "works.title all lowercase": (["title"], same(c("title"), F.lower, 10)),
            "works.subtitle ALL CAPS": (["subtitle"], same(c("subtitle"), F.upper, 3)), "works.subtitle all lowercase": (["subtitle"], same(c("subtitle"), F.lower, 5)),
        },
        "persons": {"persons.preferred_name leading punct": (["preferred_name"], c("preferred_name").rlike(edge))},
        "organizations": {"organizations.name double spaces": (["name"], c("name").rlike(r"\s{2,}"))},
        "venues": {
            "venues.name leading punct": (["name"], c("name").rlike(edge)),
            "venues.issn without hyphen": (["issn"], c("issn").rlike("^[0-9Xx]{8}$")), "venues.eissn without hyphen": (["eissn"], c("eissn").rlike("^[0-9Xx]{8}$")),
        },
        "publications": {
            "publications.doi upper": (["doi"], c("doi") != F.lower("doi")), "publications.doi prefixed": (["doi"], c("doi").rlike(prefix)),
            "publications placeholders": (["volume", "issue", "pages"], none(c("volume")) | none(c("issue")) | none(c("pages"))),
        },
        "work_references": {"work_references.cited_doi upper": (["cited_doi"], c("cited_doi") != F.lower("cited_doi"))},
    }
    out = None
    for table, tests in signals.items():
        tests = {k: v for k, (needs, v) in tests.items() if table in catalog and set(needs) <= set(catalog[table].columns)}
        if tests:
            counts = F.array(*[F.struct(F.lit(k).alias("label"), F.count_if(v).alias("n")) for k, v in tests.items()])
            rows = catalog[table].agg(counts.alias("all")).select(F.inline("all"))
            out = rows if out is None else out.unionByName(rows)
    return out


def column_stats(before: DataFrame, wanted: Column, after: DataFrame, column: str) -> DataFrame:
    """Scanned, changed, updated, skipped_integrity, skipped_empty of a column: of the values there, those that cleaning would change, did
    change, could not because another row holds the value, and would not because nothing would be left."""
    old = before.select("id", F.col(column).alias("old"), wanted.alias("new")).where("old is not null")
    rows = old.join(after.select("id", F.col(column).alias("now")), "id")
    differs = ~F.col("new").eqNullSafe(F.col("old"))
    empty = differs & (F.col("new") == "")
    moved = ~F.col("now").eqNullSafe(F.col("old"))
    return rows.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(differs & ~F.coalesce(empty, F.lit(False))).alias("changed"), F.count_if(moved).alias("updated"),
        F.count_if(differs & ~moved & ~F.coalesce(empty, F.lit(False))).alias("skipped_integrity"), F.count_if(empty).alias("skipped_empty"),
    )


def title_subtitle_phase(catalog: Catalog) -> Catalog:
    """Titles split at their first colon where there is no subtitle yet and neither part would be empty."""
    works = catalog["works"]
    if not {"title", "subtitle"} <= set(works.columns):
        return catalog
    parts = text.split_title(F.col("title"), F.col("subtitle"))
    return catalog | {"works": works.withColumn("__parts", parts).withColumns({c: F.col(f"__parts.{c}") for c in ("title", "subtitle")}).drop("__parts")}


#: Phases of the clean-up by name, in their order.
PHASES: dict[str, Callable[[Catalog], Catalog]] = {"text": text_phase, "sentinel": sentinel_phase, "identifiers": identifier_phase, "title_subtitle": title_subtitle_phase, "capitalization": capitalization_phase}


def run(catalog: Catalog, phases: tuple[str, ...] = tuple(PHASES), tables: tuple[str, ...] | None = None, mode: str = "run") -> tuple[Catalog, DataFrame | None]:
    """(catalog, profile): the phases asked for over the tables asked for. mode profile changes nothing, both profiles the catalog as it was."""
    if mode not in ("profile", "run", "both"):
        raise ValueError("mode is profile, run or both")
    if unknown := set(phases) - set(PHASES):
        raise ValueError(f"no such phase: {sorted(unknown)}")
    chosen = {n: t for n, t in catalog.items() if tables is None or n in tables}
    signals = profile(chosen) if mode != "run" else None
    if mode != "profile":
        for name, phase in PHASES.items():
            if name in phases and (name not in ("title_subtitle", "capitalization") or "works" in chosen):
                chosen = phase(chosen)
    return catalog | chosen, signals
