"""The clean-up with its counters, and with a limit on the values that it looks at.

A phase writes each table once; the counters are observed in that pass. A limit takes the values of the least ids: the id
it ends at is found by a top-k over each partition, without a sort of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.places import title_case
from ..scratch import Scratch
from . import cleanup
from .keys import skip_on_conflict

COUNTERS = ("scanned", "changed", "updated", "skipped_integrity", "skipped_empty")


class Step(NamedTuple):
    """What cleaning wants of a column, what it makes of that, and whether (and within what) no other row may hold it."""

    column: str
    wanted: Callable[[Column], Column]
    taken: Callable[[Column, Column], Column]
    unique: tuple[str, ...] | None = None


def _wanted(old: Column, new: Column) -> Column:
    return new


def _titled(c: Column) -> Column:
    """A column as the capitalization phase leaves it."""
    whole = text.all_upper(F.trim(c)) | text.all_lower(F.trim(c))
    return text.upper_first(F.when(whole, title_case(F.trim(c))).otherwise(c))


def steps(phase: str, table: str, df: DataFrame) -> Iterator[Step]:
    """The steps of a phase over a table, in their order; splitting titles is no step of one column."""
    key = lambda c: cleanup.UNIQUE.get((table, c)) if "id" in df.columns else None
    if phase == "text":
        for c in cleanup.text_columns(df, table):
            clean = text.abstract_cleaned if (table, c) == ("works", "abstract") else text.cleaned_text
            yield Step(c, clean, text.kept_if_shrunk, key(c))
    elif phase == "sentinel":
        for c in cleanup.text_columns(df, table):
            yield Step(c, lambda x: text.sentinel_to_null(x, text.NONE_AT_CLEANUP), _wanted)
    elif phase == "identifiers":
        for of, c, f in cleanup.IDENTIFIERS:
            if of == table and c in df.columns:
                unique = None if c == "isbn" else ("citing_work_id",) if of == "work_references" else ()
                yield Step(c, f, lambda old, new: F.when(new != "", new).otherwise(old), unique)
    elif phase == "capitalization" and table == "works":
        for c in ("title", "subtitle"):
            if c in df.columns:
                yield Step(c, _titled, _wanted)


def _cut(df: DataFrame, column: str, limit: int | None):
    """Whether a row is among the first `limit` by id of those that have a value."""
    if limit is None:
        return F.lit(True)
    least = df.where(F.col(column).isNotNull()).select("id").orderBy("id").limit(limit)  # a top-k
    last = least.agg(F.max("id").alias("last")).first().last
    return F.col("id") <= last if last is not None else F.lit(False)


def _one(df: DataFrame, step: Step, limit: int | None) -> DataFrame:
    """df after a step; __old_, __want_ and __skip_ tell what the step saw, __old_ NULL beyond the limit."""
    c = step.column
    marked = df.withColumn(f"__old_{c}", F.when(_cut(df, c, limit), F.col(c))).withColumn(f"__want_{c}", step.wanted(F.col(f"__old_{c}")))
    old, want = F.col(f"__old_{c}"), F.col(f"__want_{c}")
    new = F.when(old.isNull(), F.col(c)).otherwise(step.taken(old, want))
    if step.unique is None:
        return marked.withColumn(f"__skip_{c}", F.lit(False)).withColumn(c, new)
    within = [x for x in step.unique if x in df.columns]
    return skip_on_conflict(marked, c, new, "id", within).withColumnRenamed("skipped", f"__skip_{c}")


def _counts(columns: list[str]) -> list[Column]:
    out = []
    for c in columns:
        old, want, now, skipped = (F.col(f"__{x}_{c}") if x else F.col(c) for x in ("old", "want", "", "skip"))
        there, differs, empty = old.isNotNull(), ~want.eqNullSafe(old), F.coalesce(want == "", F.lit(False))
        moved = ~now.eqNullSafe(old)
        tests = {"scanned": there, "changed": there & differs & ~empty, "updated": there & moved, "skipped_integrity": there & differs & ~moved & ~empty & (skipped | F.lit(False)), "skipped_empty": there & differs & empty}
        out += [F.count_if(t).alias(f"{c}.{name}") for name, t in tests.items()]
    return out


def _split(df: DataFrame, limit: int | None) -> tuple[DataFrame, list[Column]]:
    """Titles split, and what is counted: titles with a colon and no subtitle, those split, and those a part of which would be empty."""
    open_ = F.col("title").contains(":") & F.col("subtitle").isNull()
    here = df.withColumn("__open", F.coalesce(open_, F.lit(False)))
    if limit is not None:
        here = here.withColumn("__open", F.col("__open") & _cut(here.where("__open"), "title", limit))
    parts = F.when(F.col("__open"), text.split_title(F.col("title"), F.col("subtitle")))
    split = here.withColumn("__parts", parts).withColumn("__fits", F.coalesce(F.col("__parts.subtitle").isNotNull(), F.lit(False)))
    out = split.withColumns({c: F.when(F.col("__fits"), F.col(f"__parts.{c}")).otherwise(F.col(c)) for c in ("title", "subtitle")})
    never = F.count_if(F.lit(False))
    counts = {"scanned": F.count_if("__open"), "changed": F.count_if("__fits"), "updated": F.count_if("__fits"), "skipped_integrity": never, "skipped_empty": F.count_if(F.col("__open") & ~F.col("__fits"))}
    return out, [v.alias(f"title.{k}") for k, v in counts.items()]


def run_counted(spark: SparkSession, catalog: cleanup.Catalog, phases: tuple[str, ...] = tuple(cleanup.PHASES), tables: tuple[str, ...] | None = None, limit: int | None = None) -> tuple[cleanup.Catalog, DataFrame]:
    """(catalog, counters) of the phases asked for: phase, table, column and COUNTERS of each column that a phase looks at.

    Of a column's values scanned are those there, changed those that cleaning would change to something, updated those
    that are other now; skipped_integrity could not change, as another row holds the value, skipped_empty would not, as nothing would be
    left. limit: how many values of a column are looked at, by id.
    """
    if unknown := set(phases) - set(cleanup.PHASES):
        raise ValueError(f"no such phase: {sorted(unknown)}")
    scratch, out, counted = Scratch(spark, "cleanup"), dict(catalog), []
    for phase in cleanup.PHASES:
        for table in [t for t in catalog if phase in phases and (tables is None or t in tables)]:
            df = out[table]
            if phase == "identifiers" and table == "work_references":
                df = cleanup.without_doi_twins(df)
            if phase == "title_subtitle":
                if table != "works" or not {"title", "subtitle"} <= set(df.columns):
                    continue
                after, counts = _split(df, limit)
                columns = ["title"]
            else:
                columns, after = [], df
                for step in steps(phase, table, df):
                    after = _one(after, step, limit)
                    columns.append(step.column)
                counts = _counts(columns)
            if columns:
                seen = Observation()
                out[table] = scratch.write(after.observe(seen, *counts).select(*out[table].columns), f"{phase}-{table}")
                counted += [(phase, table, c, *(seen.get[f"{c}.{x}"] for x in COUNTERS)) for c in columns]
    schema = "phase string, table string, column string, " + ", ".join(f"{c} long" for c in COUNTERS)
    return out, spark.createDataFrame(counted, schema)
