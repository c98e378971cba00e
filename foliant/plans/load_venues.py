"""Loading venues from the three registries (M41 over J27 to J29, M20, M22 to M26, M40)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers, places, text, values
from ..operators import entities, records, venues
from ..operators.identity import connected
from ..operators.keys import new_ids
from ..operators.resolve import repointed
from ..operators.venue_conflicts import Settled, settle
from ..scratch import Scratch

Catalog = dict[str, DataFrame]


def _found(stored: DataFrame, rows: DataFrame, keys: list[tuple[str, Column, Column]], issns: Column | None = None) -> DataFrame:
    """rid, id by the ladder of a registry: an ISSN of either kind in either column first, then keys, then name and type."""
    named = F.concat_ws("\x1f", F.lower(F.nullif(F.trim("name"), F.lit(""))), "type")
    named = F.when(F.trim("name") != "", named)
    return entities.venue_ladder(rows, stored, "rid", [*keys, ("name", named, named)], issns=issns).select("rid", "id")


def _settled(c: Catalog, everyone: DataFrame, named: DataFrame, registry: str, merging: bool, both_issns: bool) -> tuple[Catalog, Settled]:
    """The catalog with venues that the records swallow merged and their children repointed, and what is left to say of each venue."""
    done = settle(everyone, named, venues.POLICY[registry], merging, both_issns)
    return repointed(c | {"venues": done.venues}, "venues", done.merged), done


def _stored(c: Catalog, rows: DataFrame, found: DataFrame, numbers: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(venues with those that rows name and nothing matched, rows with their id); rows without a name make none.

    New rows that share an ISSN, a number, or name and type, directly or by way of others, are one venue.
    """
    scratch = Scratch(rows.sparkSession, "stored")
    with_id = scratch.write(rows.join(found, "rid", "left"), "rows")
    fresh = with_id.where("id is null and name <> ''").drop("id")
    roots = connected(fresh, "rid", entities.venue_keys(*numbers))
    key = F.coalesce(F.col("issn"), F.col("eissn"), F.concat_ws("\x1f", F.lower("name"), "type"))
    rooted = scratch.write(fresh.withColumn("__key", key).join(roots, "rid"), "rooted")
    firsts = new_ids(c["venues"], "id", rooted.groupBy("root").agg(F.min("__key").alias("__key")), "__key")
    keyed = scratch.write(rooted.drop("__key").join(firsts.select("root", "id"), "root").drop("root"), "keyed")
    kept = [x for x in keyed.columns if x in c["venues"].columns and x != "id"]
    once = keyed.groupBy("id").agg(*[F.min_by(x, F.when(F.col(x).isNotNull(), F.col("rid"))).alias(x) for x in kept])
    everyone = c["venues"].unionByName(once, allowMissingColumns=True).select(*c["venues"].columns)
    return everyone, with_id.where("id is not null").unionByName(keyed, allowMissingColumns=True)


def _published(c: Catalog, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(organisations, rows with publisher_id)."""
    orgs, ids = venues.publishers(c["organizations"], rows.select(F.col("publisher").alias("name")).where("name is not null"))
    return orgs.select(*c["organizations"].columns), rows.join(ids.withColumnRenamed("name", "publisher"), "publisher", "left")


def scimago(c: Catalog, rows: DataFrame, as_of: Column, codes: DataFrame | None = None, dry_run: bool = False) -> tuple[Catalog, DataFrame]:
    """(catalog, rid and id of each row) of rows with the ranking file's columns. A dry run changes nothing."""
    scratch = Scratch(rows.sparkSession, "scimago")
    t = lambda name: F.trim(F.col(f"`{name}`"))
    pair = identifiers.issn_pair(F.col("Issn"))
    said = rows.select(
        F.concat_ws("\x1f", "path", "Sourceid", "Title").alias("rid"), text.clean_string(t("Title"), 512).alias("name"), values.venue_type(F.col("Type"), "scimago").alias("type"), pair["issn"].alias("issn"), pair["eissn"].alias("eissn"),
        text.clean_string(t("Sourceid"), 50).alias("scopus_id"), text.clean_string(t("Publisher"), 512).alias("publisher"), t("Country").alias("country"), F.col("Categories").alias("categories"), values.decimal_thousands(F.col("SJR")).alias("sjr"),
        text.whole_number(F.col("`H index`")).alias("h_index"), values.flag(F.col("`Open Access`")).alias("open_access"),
    )
    said = scratch.write(places.country_codes(said, "country", codes, misspelt=True), "said")
    found = scratch.write(_found(c["venues"], said, [("scopus_id", F.col("scopus_id"), F.col("scopus_id"))]), "found")
    if dry_run:
        return c, found
    orgs, said = _published(c, said)
    everyone, named = _stored(c, said, found, ("scopus_id",))
    named = scratch.write(named, "named")
    one = named.groupBy("id").agg(F.max_by(F.struct(*[x for x in named.columns if x not in ("id", "rid")]), "rid").alias("r")).select("id", "r.*")
    out = venues.update_scimago(everyone, one, as_of).select(*everyone.columns)
    links, subjects = venues.link_categories(c["venue_subjects"], c["subjects"], one.select(F.col("id").alias("venue_id"), "categories"))
    return c | {"venues": out, "organizations": orgs, "venue_subjects": links, "subjects": subjects}, named.select("rid", "id")


def scopus(c: Catalog, titles: DataFrame, as_of: Column, dry_run: bool = False, merging: bool = True) -> tuple[Catalog, DataFrame]:
    """(catalog, path and id of each title): entries found by ISSN, Scopus number, name and type or the file's own id, or made; what clashes is settled,
    subject areas are linked (M11). M24: titles without an entry leave the status of their error on the venue whose ISSN the request asked for, else on the file's."""
    scratch = Scratch(titles.sparkSession, "scopus")
    said = scratch.write(venues.scopus_entries(titles).withColumn("rid", F.col("path")), "said")
    fallback = [("scopus_id", F.col("scopus_id"), F.col("scopus_id"))]
    found = _found(c["venues"], said, fallback)
    own = said.join(found, "rid", "left_anti").join(c["venues"].select(F.col("id").alias("fallback_id")), "fallback_id").select("rid", F.col("fallback_id").alias("id"))
    found = scratch.write(found.unionByName(own), "found")
    if dry_run:
        return c, found.select(F.col("rid").alias("path"), "id")
    orgs, said = _published(c, said)
    everyone, named = _stored(c, said, found, ("scopus_id",))
    named = scratch.write(named, "named")
    kinds = named.withColumns({"type": F.when(F.col("type") != "OTHER", F.col("type"))})
    c, done = _settled(c | {"organizations": orgs}, everyone, kinds, "scopus", merging, True)
    out = venues.update_scopus(done.venues, done.records, as_of)
    ids = _now(named.select("rid", "id"), done.merged)
    asked = identifiers.issn_of_links(F.col("links")) if "links" in titles.columns else F.lit(None).cast("string")
    failed = titles.where("entry is null").select(F.monotonically_increasing_id().alias("rid"), asked.alias("issn"), F.lit(None).cast("string").alias("eissn"), identifiers.venue_of_file(F.col("path")).alias("own"), venues.status_of_error(F.col("error")).alias("status"))
    failed = scratch.write(failed.where("issn is not null or own is not null"), "failed")
    by_issn = entities.venue_ladder(failed, out, "rid", []).select("rid", "id")
    at = failed.join(by_issn, "rid", "left").select(F.coalesce("id", "own").alias("id"), F.coalesce("status", F.lit("FAILED")).alias("status"))
    at = at.where("id is not null").groupBy("id").agg(F.min("status").alias("__status"))
    status = {"validation_status": F.coalesce("__status", "validation_status"), "last_validated_at": F.when(F.col("__status").isNotNull(), as_of).otherwise(F.col("last_validated_at"))}
    out = out.join(at, "id", "left").withColumns(status).select(*everyone.columns)
    c = c | {"venues": out}
    if "subjects" in c and "venue_subjects" in c:
        areas = named.select("rid", F.posexplode("subject_areas").alias("i", "a")).where("a.term <> ''")
        uri = F.when(F.col("a.code") != "", F.concat(F.lit("scopus:subject-area:"), F.col("a.code")))
        areas = areas.select("rid", "i", uri.alias("external_uri"), F.col("a.term").alias("term"), F.lit(None).cast("long").alias("parent_id"))
        c = _linked(c, *_areas(c, areas), ids, "scopus")
    return c, ids.select(F.col("rid").alias("path"), "id")


def _areas(c: Catalog, areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(subjects, rid and subject_id) of the subject areas of Scopus: one without a number is known by its term."""
    keyed = areas.withColumn("__key", F.coalesce("external_uri", F.concat(F.lit("term:"), text.term_key(F.col("term")))))
    one = keyed.groupBy(F.col("__key").alias("rid")).agg(F.min_by("term", F.struct(areas["rid"], "i")).alias("term"), F.min("external_uri").alias("external_uri"), F.min("parent_id").alias("parent_id"))
    subjects, links = entities.subjects(c["subjects"], one, "Scopus", "SubjectArea")
    links = Scratch(areas.sparkSession, "areas").write(links, "links")
    return subjects, keyed.join(links.select(F.col("rid").alias("__key"), F.col("id").alias("subject_id")), "__key").select("rid", "subject_id")


def _now(ids: DataFrame, merged: DataFrame) -> DataFrame:
    """rid and id, of venues that were merged the id of what they were merged into."""
    return ids.join(merged.withColumnRenamed("duplicate", "id"), "id", "left").select("rid", F.coalesce("canonical", "id").alias("id"))


def _linked(c: Catalog, subjects: DataFrame, of_rid: DataFrame, ids: DataFrame, source: str | None) -> Catalog:
    """The catalog with those subjects and the venues' links to them; links that are there stay as they are."""
    new = of_rid.join(ids, "rid").select(F.col("id").alias("venue_id"), "subject_id").distinct()
    held = c["venue_subjects"].select("venue_id", "subject_id").distinct()
    new = new.join(held, ["venue_id", "subject_id"], "left_anti").withColumns({"score": F.lit(None).cast("double"), "source": F.lit(source).cast("string")})
    return c | {"subjects": subjects, "venue_subjects": c["venue_subjects"].unionByName(new.select(*[x for x in new.columns if x in c["venue_subjects"].columns]), allowMissingColumns=True)}


def openalex(c: Catalog, found_: DataFrame, as_of: Column, dry_run: bool = False, merging: bool = True) -> tuple[Catalog, DataFrame]:
    """(catalog, path and id of each record) of OpenAlex venues (path and the record's columns).

    A record is found by any ISSN it lists, then by its OpenAlex, Wikidata and MAG numbers, then by name and type; the rest are
    new venues, one for records that share any of these. Values that another venue holds are settled, what remains
    enriches the venue by policy, pending ones become valid, and their topics, with all that stands above them, are linked.
    """
    scratch = Scratch(found_.sparkSession, "openalex-venues")
    said = scratch.write(venues.openalex_venue(found_), "said")
    numbers = ("openalex_id", "wikidata_id", "mag_id")
    found = scratch.write(_found(c["venues"], said, [(n, F.col(n), F.col(n)) for n in numbers], F.col("issns")), "found")
    if dry_run:
        return c, found.select(F.col("rid").alias("path"), "id")
    levels = records.openalex_topics(said.select("rid", "topics"))
    orgs, said = _published(c, said.drop("issns", "topics"))
    everyone, named = _stored(c, said.withColumn("type", F.coalesce("type", F.lit("OTHER"))), found, numbers)
    # A record without a type says nothing of a stored venue's; only a new one is OTHER for that.
    spoken = named.drop("type").join(said.select("rid", "type"), "rid")
    named = scratch.write(spoken, "named")
    c, done = _settled(c | {"organizations": orgs}, everyone, venues.openalex_types(everyone, named), "openalex", merging, False)
    out = venues.apply_policy(done.venues, done.records, "id", venues.POLICY["openalex"])
    c = c | {"venues": venues.validated(out, done.records, as_of)}
    ids = scratch.write(_now(named.select("rid", "id"), done.merged), "ids")
    if "subjects" in c and "venue_subjects" in c:
        kinds = tuple(kind for _, kind in records.LEVELS)
        levels = scratch.write(levels, "levels")
        subjects, last = entities.hierarchy(c["subjects"], levels, "OpenAlex", kinds, complete=True)
        of_rid = levels.where(F.col("level") == kinds[-1]).join(last, "external_uri").select("rid", F.col("id").alias("subject_id"))
        c = _linked(c, subjects, of_rid, ids, None)
    return c, ids.select(F.col("rid").alias("path"), "id")
