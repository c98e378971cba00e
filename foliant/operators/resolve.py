"""Entity resolution: prioritised ladders of keys, and matches across two columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def ladder(records: DataFrame, existing: DataFrame, rid: str, eid: str, keys: list[tuple[str, Column, Column]]) -> DataFrame:
    """Rid, eid, rung of each record's best match: the first rung that matches, then the least id.

    Each rung is (name, key of a record, key of an existing row). All rungs go through one equi-join on
    (rung, key), and the best match is an aggregate, so a common key needs no sort of its matches.
    """
    def keyed(df, pk, side):
        pairs = F.array(*[F.struct(F.lit(k).alias("rung"), key[side].cast("string").alias("key")) for k, key in enumerate([(r, e) for _, r, e in keys])])
        return df.select(F.col(pk).alias(pk), F.explode(pairs).alias("p")).select(pk, "p.rung", "p.key").where("key is not null")

    targets = keyed(existing, eid, 1).groupBy("rung", "key").agg(F.min(eid).alias(eid))
    best = keyed(records, rid, 0).join(targets, ["rung", "key"]).groupBy(rid).agg(F.min(F.struct("rung", eid)).alias("m"))
    names = F.array(*[F.lit(n) for n, _, _ in keys])
    return best.select(rid, F.col(f"m.{eid}").alias(eid), F.get(names, F.col("m.rung")).alias("rung"))


def issn_match(records: DataFrame, rid: str, issns: list[Column], venues: DataFrame) -> DataFrame:
    """The least venue that has any of a record's ISSNs in either column, hyphens aside."""
    compact = lambda c: F.upper(F.regexp_replace(c, r"[\s-]", ""))
    mine = records.select(rid, F.explode(F.array(*map(compact, issns))).alias("key")).where("key <> ''").distinct()
    theirs = venues.select(F.col("id").alias("venue_id"), F.explode(F.array(compact(F.col("issn")), compact(F.col("eissn")))).alias("key")).where("key <> ''")
    return mine.join(theirs.groupBy("key").agg(F.min("venue_id").alias("venue_id")), "key").groupBy(rid).agg(F.min("venue_id").alias("venue_id"))


def duplicate_issns(venues: DataFrame) -> DataFrame:
    """(duplicate, canonical) of venues that share an ISSN in either column with a lower id."""
    each = venues.select("id", F.explode(F.array("issn", "eissn")).alias("key")).where("key is not null").distinct()
    least = each.groupBy("key").agg(F.min("id").alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return each.join(least, "key").where("id <> canonical").groupBy(F.col("id").alias("duplicate")).agg(F.min("canonical").alias("canonical"))


def remap(child: DataFrame, column: str, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows with column repointed by pairs (duplicate, canonical), each key once, own rows first."""
    moved = child.join(pairs.withColumnRenamed("duplicate", column), column, "left")
    rows = moved.withColumn("__moved", F.col("canonical").isNotNull()).withColumn(column, F.coalesce("canonical", column)).drop("canonical")
    rest = [c for c in rows.columns if c not in keys and c != "__moved"]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("__moved", *rest)).alias("r")) if rest else rows.select(*keys).distinct()
    return first.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]) if rest else first


# The columns that name a row of a parent table, and the keys of tables in which a row must not occur twice.
CHILDREN = {
    "venues": (("publications", "venue_id"), ("venue_subjects", "venue_id")),
    "organizations": (("authorships", "affiliation_id"), ("funding", "funder_id"), ("programs", "institution_id"), ("publications", "publisher_id"), ("venues", "publisher_id")),
    "persons": (("authorships", "person_id"), ("course_instructors", "person_id")),
    "subjects": (("work_subjects", "subject_id"), ("venue_subjects", "subject_id"), ("subjects", "parent_id")),
    "works": (("authorships", "work_id"), ("publications", "work_id"), ("work_subjects", "work_id"), ("work_references", "citing_work_id"), ("funding", "work_id")),
}
KEYS = {
    "venue_subjects": ("venue_id", "subject_id"), "work_subjects": ("work_id", "subject_id"), "funding": ("work_id", "funder_id", "grant_number"),
    "work_references": ("citing_work_id", "cited_doi"), "authorships": ("work_id", "person_id", "role"),
}


def followed(pairs: DataFrame, most: int = 60) -> DataFrame:
    """(duplicate, canonical) with each chain of merges followed to its end; of several canonical rows the least counts.

    A round takes every canonical row's own canonical one, so chains halve; a ring has no end and raises ValueError.
    """
    scratch = Scratch(pairs.sparkSession, "followed")
    rows = pairs.where("duplicate <> canonical").groupBy("duplicate").agg(F.min("canonical").alias("canonical"))
    rows = scratch.write(rows, "0")
    for k in range(1, most):
        on = rows.select(F.col("duplicate").alias("canonical"), F.col("canonical").alias("__next"))
        if rows.join(on, "canonical", "left_semi").isEmpty():
            return rows
        step = rows.join(on, "canonical", "left").select("duplicate", F.coalesce("__next", "canonical").alias("canonical"))
        if not step.where("duplicate = canonical").isEmpty():
            break
        rows = scratch.write(step, str(k))
    raise ValueError("rows are to be merged into each other in a ring")


def repointed(catalog: dict[str, DataFrame], parent: str, pairs: DataFrame) -> dict[str, DataFrame]:
    """Every table of the catalog that names a row of parent, with duplicates replaced by what they were merged into.

    A row that would then have the key of another gives way to that one, moved rows to own ones. pairs are followed().
    """
    out = dict(catalog)
    for table, column in CHILDREN[parent]:
        if table not in out or column not in out[table].columns:
            continue
        df, keys = out[table], [k for k in KEYS.get(table, ()) if k in out[table].columns]
        if keys and column in keys:
            out[table] = remap(df, column, pairs, keys).select(*df.columns)
        else:
            to = pairs.select(F.col("duplicate").alias(column), F.col("canonical").alias("__to"))
            out[table] = df.join(to, column, "left").withColumn(column, F.coalesce("__to", column)).select(*df.columns)
    return out


def merge_organizations(catalog: dict[str, DataFrame], primary: int, secondary: int) -> dict[str, DataFrame]:
    """Organisation secondary folded into primary: numbers and address that primary lacks are filled, five tables repointed, secondary deleted.

    A row that would then have the key of another, of authorships or funding, is dropped in its favour.
    """
    if primary is None or secondary is None:
        raise ValueError("both organisations must be given")
    if primary == secondary:
        raise ValueError("an organisation can't be merged into itself")
    orgs = catalog["organizations"]
    there = {r.id for r in orgs.where(F.col("id").isin(primary, secondary)).select("id").distinct().collect()}
    if there != {primary, secondary}:
        raise ValueError("one or both organisations don't exist")
    other = orgs.where(F.col("id") == secondary)
    filled = [c for c in ("ror_id", "wikidata_id", "openalex_id", "mag_id", "url") if c in orgs.columns]
    theirs = {c: other.agg(F.max(c)).scalar() for c in filled}
    mine = F.col("id") == primary
    out = dict(catalog)
    out["organizations"] = orgs.where(F.col("id") != secondary).withColumns({c: F.when(mine, F.coalesce(F.col(c), theirs[c])).otherwise(F.col(c)) for c in filled})
    pairs = orgs.sparkSession.createDataFrame([(secondary, primary)], "duplicate long, canonical long")
    for table, column in (("authorships", "affiliation_id"), ("funding", "funder_id"), ("programs", "institution_id"), ("publications", "publisher_id"), ("venues", "publisher_id")):
        if table in out:
            if table == "funding":
                keys = [c for c in ("work_id", "funder_id", "grant_number") if c in out[table].columns]
                out[table] = remap(out[table], column, pairs, keys).select(*out[table].columns)
            else:
                out[table] = out[table].withColumn(column, F.when(F.col(column) == secondary, F.lit(primary)).otherwise(F.col(column)))
    return out
