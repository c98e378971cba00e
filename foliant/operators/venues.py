"""Venues from three registries: update policies, merging duplicates, publishers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers, text, values
from . import entities
from .keys import merge_scores, new_ids
from .resolve import followed, repointed

# The columns of a venue that merging treats alike.
UNIQUE = ("issn", "eissn", "scopus_id", "wikidata_id", "openalex_id", "mag_id")
FILLED = ("abbreviated_name", "publisher_id", "country_code", "issn", "eissn", "homepage_url", "aggregation_type", "scopus_id", "wikidata_id", "openalex_id", "scielo_id", "mag_id")
FLAGS = ("open_access", "is_in_doaj", "is_in_scielo", "is_indexed_in_scopus")
#: Rules of the columns by registry. blank: fill what is NULL or blank; null: fill NULL only; overwrite; max.
POLICY = {
    "openalex": {
        "name": "blank", "type": "overwrite", "homepage_url": "overwrite", "country_code": "overwrite", "open_access": "overwrite", "is_in_doaj": "overwrite",
        "is_indexed_in_scopus": "overwrite", "issn": "blank", "eissn": "blank", "openalex_id": "blank", "wikidata_id": "blank", "mag_id": "blank",
        "publisher_id": "blank", "h_index": "blank", "i10_index": "blank", "2yr_mean_citedness": "blank",
    },
    "scimago": {
        "issn": "null", "eissn": "null", "scopus_id": "null", "publisher_id": "null", "country_code": "null", "sjr": "overwrite", "open_access": "overwrite", "h_index": "max",
    },
    "scopus": {
        "name": "blank", "type": "overwrite", "issn": "blank", "eissn": "blank", "scopus_id": "blank", "publisher_id": "blank", "homepage_url": "overwrite", "open_access": "overwrite", "is_in_doaj": "overwrite",
        "is_indexed_in_scopus": "overwrite", "aggregation_type": "overwrite", "citescore": "overwrite", "snip": "overwrite", "sjr": "overwrite", "validation_status": "overwrite",
    },
}


def apply_policy(existing: DataFrame, incoming: DataFrame, key: str, policy: dict[str, str]) -> DataFrame:
    """Existing with the columns of policy brought up to date from incoming, at most one row a key there.

    Columns that either side lacks stay as they are. Values that are NULL or blank change nothing.
    """
    shared = {c: rule for c, rule in policy.items() if c in existing.columns and c in incoming.columns}
    theirs = incoming.select(F.col(key), *[F.col(f"`{c}`").alias(f"__{c}") for c in shared])
    joined = existing.join(theirs, key, "left")
    empty = lambda c: c.isNull() | (F.trim(c.cast("string")) == "")

    def column(c, rule):
        old, new = F.col(f"`{c}`"), F.col(f"`__{c}`")
        new = F.when(~empty(new), new)
        if rule == "blank":
            return F.when(empty(old), F.coalesce(new, old)).otherwise(old)
        if rule == "null":
            return F.coalesce(old, new)
        return F.greatest(old, new) if rule == "max" else F.coalesce(new, old)

    return joined.select(*[column(c, shared[c]).alias(c) if c in shared else F.col(f"`{c}`") for c in existing.columns])


def openalex_types(venues: DataFrame, records: DataFrame) -> DataFrame:
    """Records (id and fields) whose type is that of the stored aggregation type, where there is one; one that maps to OTHER changes nothing."""
    stored = venues.select("id", F.nullif(text.stripped(F.col("aggregation_type")), F.lit("")).alias("__agg"))
    kind = values.venue_type(F.col("__agg"), "openalex")
    given = F.when(F.col("__agg").isNull(), F.col("type")).when(kind != "OTHER", kind)
    return records.join(stored, "id", "left").withColumn("type", given).drop("__agg")


def enrich_openalex(venues: DataFrame, records: DataFrame) -> DataFrame:
    """An aggregation type already stored outranks the record's type, unless it is OTHER, which changes nothing."""
    return apply_policy(venues, openalex_types(venues, records), "id", POLICY["openalex"])


def validated(venues: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    """Venues that ids name and that were pending are valid as of now."""
    rows = venues.join(ids.select("id").distinct().withColumn("__named", F.lit(True)), "id", "left")
    now = F.col("__named") & (F.coalesce("validation_status", F.lit("PENDING")) == "PENDING")
    return rows.withColumns({"validation_status": F.when(now, "VALIDATED").otherwise(F.col("validation_status")), "last_validated_at": F.when(now, as_of).otherwise(F.col("last_validated_at"))}).select(*venues.columns)


def update_scimago(venues: DataFrame, records: DataFrame, as_of: Column) -> DataFrame:
    """Venues that a record names are also indexed in Scopus and, if they were pending, validated."""
    named = records.select("id").distinct().withColumn("__named", F.lit(True))
    out = apply_policy(venues, records, "id", POLICY["scimago"]).join(named, "id", "left")
    pending = F.coalesce(F.col("validation_status"), F.lit("PENDING")) == "PENDING"
    when = F.col("__named") & F.lit(True)
    new = {
        "is_indexed_in_scopus": F.when(when & (F.coalesce("is_indexed_in_scopus", F.lit(0)) == 0), 1).otherwise(F.col("is_indexed_in_scopus")),
        "validation_status": F.when(when & pending, "VALIDATED").otherwise(F.col("validation_status")),
        "last_validated_at": F.when(when, as_of).otherwise(F.col("last_validated_at")),
    }
    return out.withColumns(new).drop("__named")


def scopus_entries(titles: DataFrame) -> DataFrame:
    """The fields of the entries of Scopus titles (entry, path), cut to their lengths; rid is the file's own id, where it has one."""
    e = lambda f: F.col(f"entry.`{f}`")
    first = lambda x: values.first_metric(F.transform(x, lambda v: v["$"]))
    kind = text.clean_string(e("prism:aggregationType"), 50)
    links = F.transform(e("link"), lambda x: F.struct(x["@ref"].alias("ref"), x["@href"].alias("href")))
    fields = {
        "name": text.clean_string(e("dc:title"), 512), "publisher": text.clean_string(e("dc:publisher"), 512), "type": values.venue_type(kind, "scopus"), "aggregation_type": F.lower(kind), "scopus_id": text.clean_string(e("source-id"), 50),
        "issn": identifiers.issn(e("prism:issn")), "eissn": identifiers.issn(e("prism:eIssn")), "homepage_url": values.homepage(e("prism:url"), links), "open_access": values.flag(e("openaccess")), "is_in_doaj": values.flag(e("openaccessArticle")),
        "citescore": values.citescore(e("citeScoreYearInfoList")["citeScoreCurrentMetric"], e("citeScoreYearInfoList")["citeScoreTracker"]), "sjr": first(e("SJRList")["SJR"]), "snip": first(e("SNIPList")["SNIP"]),
        "subject_areas": F.transform(e("subject-area"), lambda x: F.struct(text.clean_string(x["$"], 255).alias("term"), text.clean_string(x["@code"], 30).alias("code"))), "fallback_id": identifiers.venue_of_file(F.col("path")),
    }
    return titles.where("entry is not null").select("path", *[v.alias(c) for c, v in fields.items()])


def update_scopus(venues: DataFrame, records: DataFrame, as_of: Column) -> DataFrame:
    """Venues with what records (id and fields of scopus_entries) say; a type that maps to OTHER changes nothing. They are indexed and validated by that."""
    said = records.withColumns({"type": F.when(F.col("type") != "OTHER", F.col("type")), "is_indexed_in_scopus": F.lit(1), "validation_status": F.lit("VALIDATED")})
    named = records.select("id").distinct().withColumn("__named", F.lit(True))
    out = apply_policy(venues, said, "id", POLICY["scopus"]).join(named, "id", "left")
    return out.withColumn("last_validated_at", F.when(F.col("__named"), as_of).otherwise(F.col("last_validated_at"))).drop("__named").select(*venues.columns)


def conflicts(venues: DataFrame, columns: tuple[str, ...] = ("issn", "eissn")) -> DataFrame:
    """(field, value, duplicate, canonical): a value of the columns taken together, or of name and type, that a lesser venue has too."""
    each = F.array(*[F.struct(F.lit("identifier").alias("field"), F.lower(F.col(c).cast("string")).alias("value")) for c in columns], F.struct(F.lit("name").alias("field"), F.concat_ws("\x1f", F.lower("name"), "type").alias("value")))
    rows = venues.select("id", F.inline(each)).where("value is not null and trim(value) <> ''").distinct()
    least = rows.groupBy("field", "value").agg(F.min("id").alias("canonical"))
    return rows.join(least, ["field", "value"]).where("id <> canonical").select("field", "value", F.col("id").alias("duplicate"), "canonical")


def merge_by_map(venues: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(venues, what was merged: duplicate, canonical) of a map of wrong ids to right ISSNs (wrong_id, issn).

    The right venue is the least that has the ISSN in either column; where none has, a venue with the wrong one's name and type and
    that ISSN is made for each ISSN. Ids that aren't stored and ISSNs that aren't valid are left out.
    """
    wanted = pairs.select(F.col("wrong_id").cast("long").alias("duplicate"), identifiers.issn(F.col("issn")).alias("key")).where("duplicate is not null and key is not null").distinct()
    wanted = wanted.join(venues.select(F.col("id").alias("duplicate"), "name", "type"), "duplicate")
    have = venues.select("id", F.explode(F.array(identifiers.issn(F.col("issn")), identifiers.issn(F.col("eissn")))).alias("key")).where("key is not null").groupBy("key").agg(F.min("id").alias("canonical"))
    found = wanted.join(have, "key", "left")
    fresh = found.where("canonical is null").groupBy("key").agg(F.min_by(F.struct("name", "type"), "duplicate").alias("v")).select("key", "v.name", "v.type")
    made = new_ids(venues, "id", fresh, "key").withColumn("issn", F.col("key"))
    everything = venues.unionByName(made.select("id", "name", "type", "issn"), allowMissingColumns=True).select(*venues.columns)
    into = found.where("canonical is not null").select("duplicate", "canonical").unionByName(found.where("canonical is null").drop("canonical").join(made.select("key", F.col("id").alias("canonical")), "key").select("duplicate", "canonical"))
    into = into.where("duplicate <> canonical").groupBy("duplicate").agg(F.min("canonical").alias("canonical"))
    return merge_venues(everything, into), into


def link_categories(venue_subjects: DataFrame, subjects: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(venue_subjects, subjects) with the categories of rows (venue_id, categories as text).

    J31: a category is a SCImago subject, else a Scopus subject area of that name, else a new one. F63, G21: its quartile is
    its score, the best of a venue's counts. M4: a stored link keeps the greater score.
    """
    each = rows.select("venue_id", F.posexplode(values.categories(F.col("categories"))).alias("i", "c")).select("venue_id", F.left("c.term", F.lit(255)).alias("term"), values.quartile_score(F.col("c.quartile")).alias("score"))
    terms = each.withColumn("key", F.left(text.term_key(F.col("term")), F.lit(255))).where("key <> ''")
    none = F.lit(None)
    named = terms.groupBy("key").agg(F.min("term").alias("term")).select(F.col("key").alias("rid"), "term", none.cast("string").alias("external_uri"), none.cast("long").alias("parent_id"))
    everything, links = entities.subjects(subjects, named, "SCImago", "Category", fallback=("Scopus", "SubjectArea"))
    scored = terms.join(links.select(F.col("rid").alias("key"), F.col("id").alias("subject_id")), "key").groupBy("venue_id", "subject_id").agg(F.max("score").alias("score"))
    return merge_scores(venue_subjects, scored.withColumn("source", F.lit("scimago"))), everything


def openalex_venue(records: DataFrame) -> DataFrame:
    """The fields of OpenAlex venues by rid (the path), ready for the ladder and the policy; issns are all that the record lists."""
    ids = lambda c: identifiers.last_segment(text.stripped(F.col(f"ids.{c}")))
    listed = F.coalesce("issn", F.expr("cast(array() as array<string>)"))
    other = F.get(F.filter(listed, lambda x: (x != "") & ~x.eqNullSafe(F.col("issn_l"))), F.lit(0))
    flag = lambda c: F.col(c).cast("int")
    fields = {
        "name": text.stripped(F.col("display_name")), "type": F.when(F.trim("type") != "", values.venue_type(F.col("type"), "openalex")),
        "issns": F.filter(F.transform(F.concat(F.array("issn_l"), listed), identifiers.issn), lambda x: x.isNotNull()), "eissn": identifiers.issn(other),
        "homepage_url": text.stripped(F.col("homepage_url")), "country_code": text.stripped(F.col("country_code")), "open_access": flag("is_oa"), "is_in_doaj": flag("is_in_doaj"),
        "is_indexed_in_scopus": flag("is_indexed_in_scopus"), "openalex_id": ids("openalex"), "wikidata_id": ids("wikidata"), "mag_id": text.stripped(F.col("ids.mag")),
        "publisher": text.stripped(F.col("host_organization_name")), "h_index": F.col("summary_stats.h_index"), "i10_index": F.col("summary_stats.i10_index"),
        "2yr_mean_citedness": F.col("summary_stats.`2yr_mean_citedness`"),
    }
    return records.select(F.col("path").alias("rid"), *[v.alias(c) for c, v in fields.items()], identifiers.issn(F.col("issn_l")).alias("issn"), "topics")


def status_of_error(error: Column) -> Column:
    """The status that a response without an entry leaves; NULL without an error."""
    return F.when(F.lower(F.trim(error)).contains("no results found"), "NOT_FOUND").when(error.isNotNull(), "FAILED")


def merge_venues(venues: DataFrame, pairs: DataFrame) -> DataFrame:
    """Venues with each duplicate of pairs (duplicate, canonical) folded into its canonical row.

    NULL columns are filled from the duplicates, least id first; a unique value only if no other surviving venue
    holds it and no lesser canonical one claims it. Flags take the greatest value, NULL as 0. Pairs whose
    canonical venue isn't there or is itself a duplicate, and pairs of one venue, are left as they are.
    """
    fill, flags = [c for c in FILLED if c in venues.columns], [c for c in FLAGS if c in venues.columns]
    unique = [c for c in fill if c in UNIQUE]
    real = pairs.where("duplicate <> canonical").join(venues.select(F.col("id").alias("canonical")), "canonical", "left_semi")
    real = real.join(real.select(F.col("duplicate").alias("canonical")).distinct(), "canonical", "left_anti")
    into = real.groupBy(F.col("duplicate").alias("id")).agg(F.min("canonical").alias("canonical"))
    marked = venues.join(into, "id", "left")
    survivors, gone = marked.where("canonical is null").drop("canonical"), marked.where("canonical is not null")
    if not fill and not flags:
        return survivors
    best = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(f"__{c}") for c in fill]
    most = [F.max(F.coalesce(F.col(c).cast("boolean").cast("int"), F.lit(0))).alias(f"__{c}") for c in flags]
    offered = gone.groupBy(F.col("canonical").alias("id")).agg(*best, *most)
    rows = survivors.join(offered.withColumn("__merged", F.lit(True)), "id", "left")
    if unique:
        def spread(prefix):
            return F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.lower(F.col(f"{prefix}{c}").cast("string")).alias("value")) for c in unique])).alias("u")

        held = survivors.select("id", spread("")).select("id", "u.*").where("value is not null").groupBy("field", "value").agg(F.min("id").alias("holder"))
        asked = offered.select("id", spread("__")).select("id", "u.*").where("value is not null")
        first = asked.groupBy("field", "value").agg(F.min("id").alias("first"))
        # An own value of the same row needs no guard: that column isn't NULL and isn't filled.
        barred = asked.join(first, ["field", "value"]).join(held, ["field", "value"], "left").where("first <> id or holder is not null")
        rows = rows.join(barred.groupBy("id").agg(F.collect_set("field").alias("__barred")), "id", "left")
    else:
        rows = rows.withColumn("__barred", F.array().cast("array<string>"))

    def column(c):
        if c in flags:
            return F.when(F.col("__merged"), F.greatest(F.coalesce(F.col(c).cast("boolean").cast("int"), F.lit(0)), F.col(f"__{c}"))).otherwise(F.col(c).cast("int"))
        free = ~F.coalesce(F.array_contains("__barred", c), F.lit(False)) if c in unique else F.lit(True)
        return F.coalesce(F.col(c), F.when(free, F.col(f"__{c}")))

    return rows.select(*[column(c).alias(c) if c in fill + flags else F.col(f"`{c}`") for c in venues.columns])


def merge_in(catalog: dict[str, DataFrame], pairs: DataFrame) -> dict[str, DataFrame]:
    """The catalog with venues merged by pairs (duplicate, canonical), chains followed to their end, and all that named a duplicate repointed.

    Pairs of ids that aren't stored are left out.
    """
    ids = catalog["venues"].select("id")
    known = pairs.join(ids.withColumnRenamed("id", "duplicate"), "duplicate", "left_semi").join(ids.withColumnRenamed("id", "canonical"), "canonical", "left_semi")
    into = followed(known.select("duplicate", "canonical"))
    return repointed(catalog | {"venues": merge_venues(catalog["venues"], into)}, "venues", into)


def create_missing(venues: DataFrame, records: DataFrame, match: list[str], name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(venues with new rows, records with the id they got or had); a record is stored if any column of match is equal.

    Records that are new and share a name are one venue; columns that records lack are NULL in new rows.
    """
    keyed = lambda df, pk: df.select(pk, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.lower(F.col(c).cast("string")).alias("value")) for c in match])).alias("k")).select(pk, "k.*").where("value is not null")
    theirs = keyed(venues, "id").groupBy("field", "value").agg(F.min("id").alias("id"))
    found = keyed(records, "rid").join(theirs, ["field", "value"]).groupBy("rid").agg(F.min("id").alias("id"))
    fresh = new_ids(venues, "id", records.join(found, "rid", "left_anti"), name)
    kept = [c for c in records.columns if c in venues.columns and c not in ("id", name)]
    once = fresh.groupBy("id", name).agg(*[F.min_by(c, "rid").alias(c) for c in kept])
    ids = found.unionByName(fresh.select("rid", "id"))
    return venues.unionByName(once, allowMissingColumns=True), records.join(ids, "rid")


def publishers(organizations: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(organizations with the missing names as PUBLISHER, (name, publisher_id)); an organization of any type is taken, the least id."""
    wanted = names.select(F.trim("name").alias("name")).where("name <> ''").distinct()
    have = organizations.groupBy(F.lower(F.trim("name")).alias("key")).agg(F.min("id").alias("id"))
    matched = wanted.withColumn("key", F.lower("name")).join(have, "key", "left")
    fresh = new_ids(organizations, "id", matched.where("id is null").drop("id"), "key")
    added = fresh.groupBy("id").agg(F.min("name").alias("name")).withColumn("type", F.lit("PUBLISHER"))
    ids = matched.where("id is not null").select("name", F.col("id").alias("publisher_id")).unionByName(fresh.select("name", F.col("id").alias("publisher_id")))
    return organizations.unionByName(added, allowMissingColumns=True), ids


def ranked_first(*choices: Column) -> Column:
    """The first choice that is neither NULL nor blank."""
    return reduce(lambda rest, c: F.when(F.trim(c.cast("string")) != "", c).otherwise(rest), reversed(choices), F.lit(None))
