"""Entities that records name: found by a ladder of keys, created where none matches, their gaps filled.

Records and stored rows meet in a few joins, whatever their number. A record takes the best match among stored rows; what it
fills there is matched again, until no record finds more. Of the rest those connected by any of their keys, directly or by way
of others, are one new entity. New ids follow the greatest stored one, by key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import identifiers, text
from ..scratch import Scratch
from .identity import connected
from .keys import new_ids
from .resolve import ladder

Rung = tuple[str, Column, Column]


def get_or_create(
    existing: DataFrame, records: DataFrame, rid: str, rungs: list[Rung], columns: dict[str, Column], fill: tuple[str, ...] = (), unique: tuple[str, ...] = (), creatable: Column | None = None, create: bool = True,
    match: Callable[[DataFrame, DataFrame], DataFrame] | None = None, same: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(entities, links): links has rid and id of every record that has an entity.

    A rung is a name, the key of a record and that of a stored row, in falling order. columns gives what a record says of its
    entity; of a new one each column has the first value by rid, of a stored one those of fill are filled where it has none. A
    value of unique that another entity has, or a lesser id takes on, is not taken. Records without a match are one entity if they
    share a key of any rung; same gives other keys for that. An entity none of whose records is creatable isn't made, nor
    is one without a key. match, of records and stored rows, is used in place of the ladder of the rungs. With
    create off nothing is made or filled: the read-only ladder.
    """
    match = match or (lambda some, stored: ladder(some, stored, rid, "id", rungs))
    if not create:
        return existing, match(records, existing).select(rid, "id")
    scratch = Scratch(records.sparkSession, "entities")
    keys = [k.cast("string") for _, k, _ in rungs]
    first_key = F.coalesce(*[F.concat(F.lit(f"{i}:"), k) for i, k in enumerate(keys)])
    own = F.array(*[F.concat(F.lit(f"{i}:"), k) for i, k in enumerate(keys)]) if same is None else same
    said = records.withColumns({"__key": first_key, "__same": own, "__may": F.lit(True) if creatable is None else creatable})
    others, seen = [c for c in said.columns if c != rid], Observation()
    said = scratch.write(said.observe(seen, F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*others)).alias("kinds")), "said")
    rest, entities, links, who = said, existing, None, None
    if 2 * seen.get.get("kinds", 0) < seen.get.get("n", 0):
        # Most records say what another one says: the first of them by rid stands for all.
        said = said.select(rid, F.struct(*others).alias("__all"))
        alike = scratch.write(said.groupBy("__all").agg(F.min(rid).alias("__first")), "alike")
        who = scratch.write(said.join(alike, "__all").select(rid, "__first"), "who")
        rest = alike.select(F.col("__first").alias(rid), "__all.*")
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(rid))).alias(c)
    says = [rid, *[v.alias(c) for c, v in columns.items()]]
    # What a match fills can be the key of another record; where nothing is filled one round says it all.
    round_ = 0
    while True:
        found = scratch.write(match(rest, entities).select(rid, "id"), f"found-{round_}")
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            break
        if fill:
            given = rest.select(*says).join(found, rid).groupBy("id").agg(*[first(c) for c in fill])
            entities = scratch.write(filled(entities, given, fill, unique), f"entities-{round_}")
        rest = rest.join(found, rid, "left_anti")
        if not fill:
            break
        rest = scratch.write(rest, f"rest-{round_}")
        round_ += 1
    rest = scratch.write(rest.where("__key is not null").select(*says, "__key", "__same", "__may"), "rest")
    roots = connected(rest, rid, F.col("__same"))
    rest = scratch.write(rest.drop("__same").join(roots, rid), "rooted")
    groups = rest.groupBy("root").agg(*[first(c) for c in columns], F.min("__key").alias("__key"), F.max(F.coalesce("__may", F.lit(False))).alias("__may")).where("__may").drop("__may")
    made = scratch.write(new_ids(existing, "id", groups, "__key"), "made")
    links = links.unionByName(rest.select(rid, "root").join(made.select("root", "id"), "root").select(rid, "id"))
    if who is not None:
        links = who.join(links.withColumnRenamed(rid, "__first"), "__first").select(rid, "id")
    types = dict(existing.dtypes)
    new = made.select("id", *[F.col(c).cast(types[c]).alias(c) for c in columns if c in types])
    return entities.unionByName(new, allowMissingColumns=True).select(*existing.columns), links


def filled(existing: DataFrame, given: DataFrame, columns: tuple[str, ...], unique: tuple[str, ...] = ()) -> DataFrame:
    """existing with the NULL or blank values of columns taken from given (id and those columns), unless they are unique and held or claimed by a lesser id."""
    types = dict(existing.dtypes)
    none = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    g = given.select("id", *[F.col(c).cast(types[c]).alias(f"__{c}") for c in columns])
    rows = existing.join(g, "id", "left")
    for c in unique:
        held = existing.where(~none(c)).select(F.col(c).alias(f"__{c}")).distinct().withColumn("__held", F.lit(True))
        claims = rows.where(none(c) & F.col(f"__{c}").isNotNull()).groupBy(f"__{c}").agg(F.min("id").alias("id")).join(held, f"__{c}", "left").where("__held is null").select("id", F.col(f"__{c}").alias("__won"))
        rows = rows.join(claims, "id", "left").withColumn(f"__{c}", F.col("__won")).drop("__won")
    return rows.withColumns({c: F.when(none(c), F.coalesce(f"__{c}", c)).otherwise(F.col(c)) for c in columns}).select(*existing.columns)


def _clean(c: Column, most: int) -> Column:
    return text.clean_string(c, most)


def persons(existing: DataFrame, records: DataFrame, rid: str = "rid", create: bool = True) -> tuple[DataFrame, DataFrame]:
    """By ORCID, then by name, which is accepted even where the stored ORCID differs. records: rid, family, given, display, orcid."""
    name = text.person_name(F.col("family"), F.col("given"), F.col("display"))
    rows = records.select(rid, name.alias("n"), identifiers.orcid_found(F.col("orcid")).alias("orcid"))
    rows = rows.select(rid, F.col("n.preferred").alias("preferred_name"), F.col("n.surname").alias("family_name"), F.col("n.given").alias("given_names"), "orcid", text.person_key(F.col("n.preferred")).alias("name_key"))
    rows = rows.where("name_key is not null")
    rungs = [("orcid", F.col("orcid"), F.col("orcid")), ("name", F.col("name_key"), text.person_key(F.col("preferred_name")))]
    columns = {c: F.col(c) for c in ("preferred_name", "family_name", "given_names", "orcid")}
    return get_or_create(existing, rows, rid, rungs, columns, ("orcid",), ("orcid",), create=create)


def organizations(existing: DataFrame, records: DataFrame, rid: str = "rid", create: bool = True) -> tuple[DataFrame, DataFrame]:
    """By ROR, OpenAlex, Wikidata and MAG number, then by name and type. records: rid, name, type and what is known of ror_id,
    openalex_id, wikidata_id, mag_id, url, country_code."""
    has = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    numbers = {"ror_id": identifiers.ror_id, "openalex_id": identifiers.last_segment, "wikidata_id": identifiers.wikidata_id, "mag_id": identifiers.mag_id}
    rows = records.select(
        rid, "type", _clean(F.col("name"), 512).alias("name"), *[f(has(c)).alias(c) for c, f in numbers.items()], _clean(has("url"), 512).alias("url"), F.left(F.upper(text.stripped(has("country_code"))), F.lit(2)).alias("country_code")
    )
    by_name = lambda n: F.concat_ws("\x1f", F.lower(F.trim(F.col(n))), "type")
    rungs: list[Rung] = [(c, F.col(c), F.col(c)) for c in numbers]
    rungs.append(("name", F.when(F.col("name").isNotNull(), by_name("name")), F.when(F.col("name").isNotNull(), by_name("name"))))
    columns = {c: F.col(c) for c in ("name", "type", "country_code", *numbers, "url")}
    return get_or_create(existing, rows, rid, rungs, columns, (*numbers, "url", "country_code"), tuple(numbers), F.col("name").isNotNull(), create)


def issn_keys(rows: DataFrame, rid: str, columns: tuple[str, ...] = ("issn", "eissn")) -> DataFrame:
    """rid, key: every ISSN of a row, in whichever column, hyphens aside."""
    return rows.select(rid, F.explode(F.array(*[compact_issn(F.col(c)) for c in columns])).alias("key")).where("key <> ''").distinct()


def compact_issn(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"[\s-]", ""))


def venue_ladder(rows: DataFrame, stored: DataFrame, rid: str, rungs: list[Rung], issn_at: int = 0, issns: Column | None = None) -> DataFrame:
    """rid, id, rung as of ladder(), with the match of an ISSN, of either kind in either column, as rung issn_at. issns: a record's ISSNs, if not those of its two columns."""
    theirs = issn_keys(stored, "id").groupBy("key").agg(F.min("id").alias("id"))
    mine = issn_keys(rows, rid) if issns is None else rows.select(rid, F.explode(F.transform(issns, compact_issn)).alias("key")).where("key <> ''").distinct()
    by_issn = mine.join(theirs, "key").groupBy(rid).agg(F.min("id").alias("__issn_id"))
    issn = ("issn", F.col("__issn_id"), F.col("id"))
    return ladder(rows.join(by_issn, rid, "left"), stored, rid, "id", [*rungs[:issn_at], issn, *rungs[issn_at:]])


def venue_keys(*numbers: str) -> Column:
    """What makes records one venue: an ISSN of either kind, one of the numbers, or name and type."""
    issns = [F.concat(F.lit("issn:"), F.nullif(compact_issn(F.col(c)), F.lit(""))) for c in ("issn", "eissn")]
    named = F.when(F.trim("name") != "", F.concat_ws("\x1f", F.lit("name:"), F.lower(F.trim("name")), "type"))
    return F.array(*issns, *[F.concat(F.lit(f"{n}:"), F.lower(F.nullif(F.trim(F.col(n).cast("string")), F.lit("")))) for n in numbers], named)


def venues(existing: DataFrame, records: DataFrame, rid: str = "rid") -> tuple[DataFrame, DataFrame]:
    """By OpenAlex number, then by either ISSN in either column, then by name and type. records: rid, name, type, issn, eissn, openalex_id.

    New venues that share a number or an ISSN, in whichever column, are one, and so are those of one name and type.
    """
    rows = records.select(rid, _clean(F.col("name"), 512).alias("name"), "type", identifiers.issn(F.col("issn")).alias("issn"), identifiers.issn(F.col("eissn")).alias("eissn"), identifiers.last_segment(F.col("openalex_id")).alias("openalex_id"))
    mine = issn_keys(rows, rid)
    shared = mine.groupBy("key").agg(F.min(rid).alias("__first"))
    rows = rows.join(mine.join(shared, "key").groupBy(rid).agg(F.min("__first").alias("__first")), rid, "left")
    by_name = F.when(F.col("name").isNotNull(), F.concat_ws("\x1f", F.lower("name"), "type"))
    rungs: list[Rung] = [("openalex_id", F.col("openalex_id"), F.col("openalex_id")), ("name", by_name, by_name)]
    # New ids go by OpenAlex number, then by the first record of an ISSN, then by name.
    order = [rungs[0], ("issn", F.concat(F.lit("r"), F.col("__first").cast("string")), F.lit(None).cast("string")), rungs[1]]
    columns = {c: F.col(c) for c in ("name", "type", "issn", "eissn", "openalex_id")}
    match = lambda some, stored: venue_ladder(some, stored, rid, rungs, 1)
    filled_ = ("issn", "eissn", "openalex_id")
    return get_or_create(existing, rows, rid, order, columns, filled_, filled_, F.col("name").isNotNull(), match=match, same=venue_keys("openalex_id"))


def keywords(existing: DataFrame, records: DataFrame, rid: str = "rid") -> tuple[DataFrame, DataFrame]:
    """Keywords (rid, term) by the key of their term, among subjects of vocabulary KEYWORD without a type."""
    rows = records.select(rid, F.left(text.stripped(F.col("term")), F.lit(255)).alias("term")).withColumn("term_key", F.left(text.term_key(F.col("term")), F.lit(255))).where("term_key <> ''")
    own = F.when((F.col("vocabulary") == "KEYWORD") & F.col("subject_type").isNull(), F.col("term_key"))
    columns = {"term": F.col("term"), "vocabulary": F.lit("KEYWORD"), "term_key": F.col("term_key")}
    return get_or_create(existing, rows, rid, [("term", F.col("term_key"), own)], columns)


def subjects(existing: DataFrame, records: DataFrame, vocabulary: str, subject_type: str, rid: str = "rid", fallback: tuple[str, str] | None = None, complete: bool = False) -> tuple[DataFrame, DataFrame]:
    """Subjects (rid, term, external_uri, parent_id) by their address, then by the key of their term within vocabulary and type,
    then among those of fallback; new ones, in English, take the parent given, and stored ones found by their address that have none.
    complete: stored ones found by their term take a missing address and parent, too."""
    rows = records.select(rid, "external_uri", "parent_id", F.left(text.stripped(F.col("term")), F.lit(255)).alias("term")).withColumn("term_key", F.left(text.term_key(F.col("term")), F.lit(255))).where("term_key <> ''")
    within = lambda v, t: F.when((F.col("vocabulary") == v) & (F.col("subject_type") == t), F.col("term_key"))
    rungs: list[Rung] = [("address", F.col("external_uri"), F.col("external_uri")), ("term", F.col("term_key"), within(vocabulary, subject_type))]
    if fallback:
        rungs.append(("fallback", F.col("term_key"), within(*fallback)))
    columns = {"term": F.col("term"), "vocabulary": F.lit(vocabulary), "subject_type": F.lit(subject_type), "lang": F.lit("en"), "external_uri": F.col("external_uri"), "parent_id": F.col("parent_id"), "term_key": F.col("term_key")}
    address = ("external_uri",) if complete else ()
    everyone, links = get_or_create(existing, rows, rid, rungs, columns, address, address)
    if complete:
        parents = rows.where("parent_id is not null").join(links, rid).groupBy("id").agg(F.min("parent_id").alias("__parent"))
        stored = everyone.join(existing.select("id", F.lit(True).alias("__old")), "id", "left").join(parents, "id", "left")
    else:
        adopted = rows.where("parent_id is not null and external_uri is not null").groupBy("external_uri").agg(F.min("parent_id").alias("__parent"))
        stored = everyone.join(existing.select("id", F.lit(True).alias("__old")), "id", "left").join(adopted, "external_uri", "left")
    return stored.withColumn("parent_id", F.when(F.col("__old"), F.coalesce("parent_id", "__parent")).otherwise(F.col("parent_id"))).select(*existing.columns), links


def hierarchy(existing: DataFrame, nodes: DataFrame, vocabulary: str, kinds: tuple[str, ...], complete: bool = False) -> tuple[DataFrame, DataFrame]:
    """(subjects, external_uri and id of the nodes of the last kind) of trees as deep as kinds, from the top down.

    nodes: rid, i, level (one of kinds), external_uri, term, parent_uri; a parent is resolved before its children, and one that a
    level lacks is no parent. Of an address given twice the first term by rid and i counts.
    """
    scratch, above, last = Scratch(nodes.sparkSession, "hierarchy"), None, None
    nodes = scratch.write(nodes, "nodes")
    for kind in kinds:
        mine = nodes.where(F.col("level") == kind)
        parents = mine.withColumn("parent_id", F.lit(None).cast("long")) if above is None else mine.join(above, "parent_uri", "left")
        one = parents.groupBy("external_uri").agg(F.min_by("term", F.struct("rid", "i")).alias("term"), F.min("parent_id").alias("parent_id")).withColumn("rid", F.col("external_uri"))
        existing, last = subjects(existing, one, vocabulary, kind, complete=complete)
        existing, last = scratch.write(existing, f"subjects-{kind}"), scratch.write(last, f"links-{kind}")
        above = last.select(F.col("rid").alias("parent_uri"), F.col("id").alias("parent_id"))
    return existing, last.select(F.col("rid").alias("external_uri"), "id")


def linked(links: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Links with the new ones whose keys aren't there; NULL is a key value, and of new ones with equal keys one counts."""
    types = dict(links.dtypes)
    fresh = new.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]).distinct()
    held = links.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return links.unionByName(fresh.join(held, same, "left_anti"), allowMissingColumns=True)
