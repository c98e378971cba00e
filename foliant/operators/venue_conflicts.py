"""Enriching many venues at once where values that must be unique clash.

Taking records one by one, the first venue that asks for a value that another one holds swallows that one or, without merging, goes
without the value. Here a round finds all such claims by joins and gives each claimed venue to the first claimant, by
record; venues that end up in one chain are folded into its head, whose records now speak for all of them. What a swallowed venue
held and the head didn't take is free in the next round. Rounds end when nothing clashes; each leaves fewer venues.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import venues
from .identity import connected
from .resolve import followed

#: Rounds after which claims must have been settled.
ROUNDS = 60


class Settled(NamedTuple):
    venues: DataFrame
    records: DataFrame  #: one row for each venue named: id and what its records say, without what was lost
    merged: DataFrame  #: duplicate, canonical
    lost: DataFrame  #: id, field, value of each value not taken because another venue has it


def said_of_each(records: DataFrame, policy: dict[str, str]) -> DataFrame:
    """One row for each id of records (rid, id and columns): of values to fill the first by rid, of others the last, of greatest ones the greatest; __at is the first rid."""
    given = lambda c: F.when(F.trim(F.col(f"`{c}`").cast("string")) != "", F.col("rid"))
    pick = {"blank": F.min_by, "null": F.min_by, "overwrite": F.max_by}
    out = [(F.max(f"`{c}`") if rule == "max" else pick[rule](F.col(f"`{c}`"), given(c))).alias(c) for c, rule in policy.items() if c in records.columns]
    return records.groupBy("id").agg(F.min("rid").alias("__at"), *out)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def _space(field: str, both_issns: bool) -> str:
    return "issn" if both_issns and field == "eissn" else field


def _claims(stored: DataFrame, said: DataFrame, policy: dict[str, str], both_issns: bool) -> DataFrame:
    """id, at, field, value, other, held: what a venue asks for and another one holds, or asked for before it.

    A pair of name and type counts as a value of the field 'name', and is asked for where either would change.
    """
    unique = [c for c in venues.UNIQUE if c in stored.columns and c in said.columns and c in policy]
    named = [c for c in ("name", "type") if c in said.columns and c in policy]
    mine = said.select("id", "__at", *[F.col(c).alias(f"__{c}") for c in (*unique, *named)]).join(stored, "id")

    def asked(c):
        new = F.when(~_blank(F.col(f"__{c}")), F.col(f"__{c}"))
        return F.when((_blank(F.col(c)) | F.lit(policy[c] == "overwrite")) & ~new.cast("string").eqNullSafe(F.col(c).cast("string")), new)

    value = lambda c: F.lower(F.trim(c.cast("string")))
    pair = lambda n, t: F.when(~_blank(n), F.concat_ws("\x1f", value(n), t))
    wants = [F.struct(F.lit(c).alias("field"), F.lit(_space(c, both_issns)).alias("space"), value(asked(c)).alias("value")) for c in unique]
    if named:
        new = [F.coalesce(asked(c), F.col(c)) if c in named else F.col(c) for c in ("name", "type")]
        changed = F.when(~pair(*new).eqNullSafe(pair(F.col("name"), F.col("type"))), pair(*new))
        wants.append(F.struct(F.lit("name").alias("field"), F.lit("name").alias("space"), changed.alias("value")))
    asks = mine.select("id", F.col("__at").alias("at"), F.inline(F.array(*wants))).where("value is not null")
    has = [F.struct(F.lit(_space(c, both_issns)).alias("space"), value(F.col(c)).alias("value")) for c in venues.UNIQUE if c in stored.columns]
    has.append(F.struct(F.lit("name").alias("space"), pair(F.col("name"), F.col("type")).alias("value")))
    held = stored.select(F.col("id").alias("other"), F.inline(F.array(*has))).where("value <> ''").distinct()
    of_stored = asks.join(held, ["space", "value"]).where("id <> other").withColumn("held", F.lit(True))
    first = asks.groupBy("space", "value").agg(F.min(F.struct("at", "id")).alias("f")).select("space", "value", F.col("f.id").alias("other"))
    # Where it is held by another venue, the first to ask gets it no more than the rest.
    free = asks.join(first, ["space", "value"]).where("id <> other").join(of_stored.select("space", "value").distinct(), ["space", "value"], "left_anti").withColumn("held", F.lit(False))
    return of_stored.unionByName(free).select("id", "at", "field", "value", "other", "held").distinct()


def _heads(claims: DataFrame) -> DataFrame:
    """duplicate, canonical: every claimed venue goes to its first claimant, and with that one to the head of the chain; of a ring the first claimant is the head."""
    parents = claims.groupBy("other").agg(F.min(F.struct("at", "id")).alias("p")).select("other", F.col("p.id").alias("id"), F.col("p.at").alias("at"))
    links = parents.select(F.concat_ws("-", "other", "id").alias("rid"), F.array(F.col("other").cast("string"), F.col("id").cast("string")).alias("keys"), "other", "id", "at")
    roots = links.join(connected(links, "rid", F.col("keys")), "rid")
    members = roots.select("root", F.col("other").alias("id"), F.lit(1).alias("claimed"), F.lit(None).cast(dict(roots.dtypes)["at"]).alias("at")).unionByName(roots.select("root", "id", F.lit(0).alias("claimed"), "at"))
    nodes = members.groupBy("root", "id").agg(F.max("claimed").alias("claimed"), F.min("at").alias("at"))
    best = nodes.where("at is not null").groupBy("root").agg(F.min(F.struct("claimed", "at", "id")).alias("h")).select("root", F.col("h.id").alias("canonical"))
    return nodes.join(best, "root").where("id <> canonical").select(F.col("id").alias("duplicate"), "canonical")


def settle(stored: DataFrame, records: DataFrame, policy: dict[str, str], merging: bool = True, both_issns: bool = False) -> Settled:
    """stored venues without those that records swallow, and what the records (rid, id and columns) may then change by policy.

    both_issns: an ISSN is held by whichever of the two columns has it. Without merging a value that another venue holds is lost, and
    of several that ask for a free value all but the first lose it; a name and type lost are both left as they are.
    """
    scratch = Scratch(records.sparkSession, "conflicts")
    stored, records = scratch.write(stored, "venues-0"), scratch.write(records, "records-0")
    spark, kind = records.sparkSession, dict(stored.dtypes)["id"]
    merged = spark.createDataFrame([], f"duplicate {kind}, canonical {kind}")
    lost = spark.createDataFrame([], f"id {kind}, field string, value string")
    for k in range(1, ROUNDS):
        said = scratch.write(said_of_each(records, policy), f"said-{k}")
        claims = scratch.write(_claims(stored, said, policy, both_issns), f"claims-{k}")
        if claims.isEmpty():
            break
        if not merging:
            lost = claims.select("id", "field", "value").distinct()
            gone = lost.groupBy("id").agg(F.collect_set("field").alias("__gone"))
            drop = lambda c: F.array_contains("__gone", "name" if c in ("name", "type") else c)
            said = said.join(gone, "id", "left")
            said = said.withColumns({c: F.when(~F.coalesce(drop(c), F.lit(False)), F.col(c)) for c in (*venues.UNIQUE, "name", "type") if c in said.columns}).drop("__gone")
            said = scratch.write(said, "kept")
            break
        pairs = scratch.write(_heads(claims), f"pairs-{k}")
        stored = scratch.write(venues.merge_venues(stored, pairs), f"venues-{k}")
        to = records.join(pairs.withColumnRenamed("duplicate", "id"), "id", "left")
        records = scratch.write(to.withColumn("id", F.coalesce("canonical", "id")).select(*records.columns), f"records-{k}")
        merged = scratch.write(followed(merged.unionByName(pairs)), f"merged-{k}")
    else:
        raise ValueError("claims did not settle")
    return Settled(stored, said.drop("__at"), merged, lost)
