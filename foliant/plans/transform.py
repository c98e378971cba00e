"""The transform in its phases, each step a pure function of the catalog (a dict of tables by name)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import citations, cleanup, integrity, metrics, persons, ranking, summaries
from ..scratch import Scratch

Catalog = dict[str, DataFrame]


def _entities(c: Catalog, **_) -> Catalog:
    """R1."""
    return cleanup.html_entities(c)


def _publications(c: Catalog, **_) -> Catalog:
    """R2, and M14, which precedes the phases."""
    return c | {"publications": integrity.open_access_from_venues(cleanup.publication_data(c["publications"]), c["venues"]).select(*c["publications"].columns)}


def _compound(c: Catalog, **_) -> Catalog:
    """R3."""
    people, wrote = persons.split_persons(c["persons"], c["authorships"])
    return c | {"persons": people, "authorships": wrote}


def _core(c: Catalog, **_) -> Catalog:
    """R4; the references' table goes by its own name there."""
    names = {"references": "work_references"}
    out = cleanup.core_data({names.get(n, n): t for n, t in c.items()})
    return {n: out[names.get(n, n)] for n in c}


def _signatures(c: Catalog, **_) -> Catalog:
    """R5."""
    spark = c["persons"].sparkSession
    stored = c.get("signatures")
    stored = spark.createDataFrame([], "id long, signature string") if stored is None else stored
    people = c["persons"] if "signature_id" in c["persons"].columns else c["persons"].withColumn("signature_id", F.lit(None).cast("long"))
    people, signatures = persons.rebuild_signatures(people, stored)
    return c | {"persons": people, "signatures": signatures}


def _references(c: Catalog, as_of: Column, **_) -> Catalog:
    """R6 to R9."""
    return c | {"references": citations.resolve(c["references"], c["publications"], as_of)}


def _statistics(c: Catalog, **_) -> Catalog:
    """R10, written back."""
    person = metrics.person_stats(c["authorships"], c["publications"])
    cited = metrics.h_index(c["authorships"], c["works"])
    people = metrics.write_back(c["persons"], person, "person_id", {"total_works": "total_works", "corresponding_author_count": "corresponding", "first_publication_year": "first_year", "latest_publication_year": "last_year"})
    people = metrics.write_back(people, cited, "person_id", {"total_citations": "total_citations", "h_index": "h_index"})
    out = c | {"persons": people}
    if "organizations" in c:
        stats = metrics.organization_stats(c["authorships"], c["works"], c["publications"])
        out["organizations"] = metrics.write_back(c["organizations"], stats, "affiliation_id", {"researcher_count": "researchers", "publication_count": "publications", "total_citations": "citations", "open_access_works_count": "open_access"})
    stats = metrics.venue_stats(c["works"], c["publications"])
    out["venues"] = metrics.write_back(c["venues"], stats, "venue_id", {"works_count": "works", "cited_by_count": "cited_by", "coverage_start_year": "start_year", "coverage_end_year": "end_year"})
    return out


def _ranking(c: Catalog, year: int, **_) -> Catalog:
    """R21, R12, written back."""
    names = ("venues", "venue_subjects", "subjects", "tiers", "authorships", "publications", "persons", "references")
    ranked = ranking.rank(*[c[n] for n in names])
    scores = [x for x in ranked.columns if x.endswith("_score")]
    venues = metrics.write_back(c["venues"], ranked, "venue_id", {x: x for x in scores})
    factors = metrics.impact_factors(c["publications"], c["works"], c["references"], year)
    return c | {"venues": metrics.write_back(venues, factors, "venue_id", {"impact_factor": "impact_factor"})}


def _summaries(c: Catalog, **_) -> Catalog:
    """R22 to R24."""
    spark = c["works"].sparkSession
    none = spark.createDataFrame([], "id long, name string, type string")
    orgs = c.get("organizations", none)
    if "type" not in orgs.columns:
        orgs = orgs.withColumn("type", F.lit(None).cast("string"))
    authors = c["authorships"].join(c["persons"].select(F.col("id").alias("person_id"), F.col("preferred_name").alias("name")), "person_id").select("work_id", F.col("person_id").alias("id"), "name", "role", "position")
    links = c.get("work_subjects", spark.createDataFrame([], "work_id long, subject_id long"))
    terms = c["subjects"] if "term" in c["subjects"].columns else c["subjects"].withColumn("term", F.lit(None).cast("string"))
    about = links.join(terms.select(F.col("id").alias("subject_id"), F.col("term").alias("name")), "subject_id").select("work_id", F.col("subject_id").alias("id"), "name")
    venues = c["venues"] if "publisher_id" in c["venues"].columns else c["venues"].withColumn("publisher_id", F.lit(None).cast("long"))
    return c | {
        "summary_publications": summaries.publications(c["works"], c["publications"], c["venues"], authors, about),
        "summary_persons": summaries.persons(c["persons"], c["authorships"], orgs),
        "summary_venues": summaries.venues(venues, orgs, c["venue_subjects"], terms),
    }


#: Phase, step; a later phase reads what earlier ones made. The last phase of a row store, reindexing, has no counterpart.
PHASES: list[tuple[int, Callable[..., Catalog]]] = [
    (1, _entities), (1, _publications), (1, _compound), (2, _core), (2, _signatures), (3, _references), (4, _statistics), (5, _ranking), (6, _summaries),
]


def run(catalog: Catalog, as_of: Column, year: int, upto: int = 6, store: Callable[[str, DataFrame], DataFrame] | None = None) -> Catalog:
    """The catalog after the phases up to upto. Each step's changed tables are written down before the next: by store(name, table), which
    gives a table back as read, or else in the shared folder. The summaries, which nothing reads, are left to be written by the caller."""
    if store is None:
        scratch = Scratch(catalog["works"].sparkSession, "transform")
        store = lambda name, df: scratch.write(df, name)
    for k, (phase, step) in enumerate(PHASES):
        if phase > upto:
            break
        after = step(catalog, as_of=as_of, year=year)
        if phase < 6:
            after = {n: store(f"{k}-{n}", t) if catalog.get(n) is not t else t for n, t in after.items()}
        catalog = after
    return catalog
