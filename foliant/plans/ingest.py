"""From files to the catalog in one job, with all that isn't loaded and why."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identifiers, text
from ..operators import titles
from ..scratch import Scratch
from ..ship import to_workers
from ..sources.records import CROSSREF, OPENALEX_WORK
from . import load

MODES = ("new", "full", "fast", "update")


class Loaded(NamedTuple):
    catalog: load.Catalog
    rejects: DataFrame  #: path, key, reason of every record that was not loaded
    counters: dict[str, int]  #: read, accepted, inserted, updated, and rejects by kind


def raw_files(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """path, value of the *.json files of a tree; most: how many of each folder, by name. Names are told apart before files are read.

    Files without a byte are no records: Spark's readers don't list them.
    """
    tree = {"recursiveFileLookup": True, "pathGlobFilter": "*.json"}
    files = spark.read.options(wholetext=True, **tree).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    if most is None:
        return files
    names = spark.read.format("binaryFile").options(**tree).load(path).select("path")
    folder = Window.partitionBy(F.regexp_replace("path", "/[^/]*$", "")).orderBy("path")
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")
    chosen = names.withColumn("__n", F.row_number().over(folder)).where(F.col("__n") <= most).select(bare("path").alias("__path"))
    return files.withColumn("__path", bare("path")).join(chosen, "__path", "left_semi").drop("__path")


def _judged(raw: DataFrame, source: str) -> DataFrame:
    """path, key, doi, reason (NULL for a record to load) and the record r of each raw text."""
    to_workers(raw.sparkSession)
    schema = {"crossref": CROSSREF, "openalex": OPENALEX_WORK}[source]
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = raw.select("path", parsed.alias("r"))
    if source == "crossref":
        message = F.coalesce("r.message", "r.crossref_response.message")
        rows = rows.select("path", F.col("r._broken").alias("broken"), F.coalesce("r.status", "r.crossref_response.status").alias("status"), message.alias("r"))
        rows = rows.withColumns({"doi": identifiers.doi_at_load(F.col("r.DOI")), "title": text.first_text(F.col("r.title")), "kind": F.col("r.type"), "sub": text.first_text(F.col("r.subtitle"))})
        rows = rows.withColumn("key", F.col("doi"))
        none = F.lit("missing-doi")
    else:
        number = F.when(F.col("r.id").contains("openalex.org/"), identifiers.last_segment(F.col("r.id"))).otherwise(F.col("r.id"))
        rows = rows.select("path", F.col("r._broken").alias("broken"), F.lit(None).cast("string").alias("status"), "r", identifiers.doi_at_load(F.col("r.doi")).alias("doi"), number.alias("number"))
        rows = rows.withColumns({"title": F.col("r.title"), "kind": F.col("r.type"), "sub": F.lit(None).cast("string"), "key": F.coalesce("doi", "number")})
        none = F.lit("missing-id")
    say = lambda x: F.concat(F.lit(f"{source}:"), x)
    # Said once: every use of the cleaned title would clean it anew.
    rows = rows.withColumn("title", text.ingest_text(F.col("title")))
    reason = F.coalesce(
        F.when(F.col("broken").isNotNull() | F.col("r").isNull() & F.col("status").isNull(), F.lit("unreadable")),
        F.when(F.col("status").isin("filtered", "not-found"), say(F.concat(F.lit("status="), F.col("status")))),
        F.when(F.col("key").isNull(), say(none)),
        F.when(F.col("title").isNull(), say(F.lit("missing-title"))),
        titles.exclusion_reason(F.col("title"), F.col("kind"), source, F.col("sub")),
    )
    return rows.select("path", "key", "doi", reason.alias("reason"), "r", *(["number"] if source == "openalex" else []))


def load_works(c: load.Catalog, raw: DataFrame, source: str, mode: str = "full") -> Loaded:
    """The catalog with the works of raw texts (path, value), and what was left out, by one of these reasons: unreadable, source:status=..,
    source:missing-.., an exclusion rule's (P1), duplicate of another path, skipped by the mode, failed.

    Each input row is either loaded or rejected once. Of one key the least path counts. Counters are observed as the rows are written.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {', '.join(MODES)}")
    scratch, seen = Scratch(raw.sparkSession, "ingest"), Observation()
    judged = _judged(raw, source).observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("fit"), F.count_if(F.col("reason") == "unreadable").alias("unreadable"))
    judged = scratch.write(judged, "judged")
    fit = judged.where("reason is null")
    first = scratch.write(fit.groupBy("key").agg(F.min("path").alias("path")), "first")
    mine = scratch.write(fit.join(first, ["key", "path"], "left_semi").dropDuplicates(["key", "path"]), "mine")
    if source == "crossref":
        after, rows = load.crossref(c, mine.select("doi", F.col("r").alias("message"), "path"), mode)
    else:
        after, rows = load.openalex(c, mine.select("r.*", "path", F.col("number").alias("openalex_id"), F.col("doi").alias("__doi")).withColumn("doi", F.col("__doi")).drop("__doi", "_broken"), mode)
    rows = scratch.write(rows.select(F.col("rid").alias("key"), "inserted"), "loaded")
    stored = load.matched(c["publications"], mine.select(F.col("key").alias("rid"), "doi", *([F.col("number").alias("openalex_id")] if source == "openalex" else [])), "full")
    left = mine.join(rows, "key", "left_anti").join(stored.select(F.col("rid").alias("key"), F.col("publication_id").isNotNull().alias("__stored")), "key", "left")
    skipped = F.col("__stored") if mode in ("new", "fast") else ~F.col("__stored") if mode == "update" else F.lit(False)
    others = fit.join(first.withColumnRenamed("path", "__first"), "key")
    copies = fit.groupBy("key", "path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path", "key", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))).alias("k"))
    rejects = judged.where("reason is not null").select("path", "key", "reason")
    rejects = rejects.unionByName(others.where("path <> __first").select("path", "key", F.lit("duplicate").alias("reason")))
    rejects = rejects.unionByName(copies.join(first, ["key", "path"], "left_semi").select("path", "key", F.lit("duplicate").alias("reason")))
    rejects = rejects.unionByName(left.select("path", "key", F.when(skipped, F.lit(f"skipped:mode={mode}")).otherwise("failed").alias("reason")))
    told, put = Observation(), Observation()
    kinds = {k: F.count_if(F.col("reason").startswith(k)) for k in ("duplicate", "skipped", "failed")}
    rejects = scratch.write(rejects.observe(told, F.count(F.lit(1)).alias("rejected"), *[v.alias(k) for k, v in kinds.items()]), "rejects")
    scratch.write(rows.observe(put, F.count_if("inserted").alias("inserted"), F.count_if(~F.col("inserted")).alias("updated")), "counted")
    scratch.drop("first", "mine", "counted")
    return Loaded(after, rejects, {**seen.get, **told.get, **put.get})


def load_tree(spark: SparkSession, path: str, source: str, c: load.Catalog, mode: str = "full", most: int | None = None) -> Loaded:
    """load_works() of the files of a tree; most: how many of each folder."""
    return load_works(c, raw_files(spark, path, most), source, mode)


def kind_of(reason: Column) -> Column:
    """A reason without what it is about."""
    return F.regexp_replace(reason, "=.*$", "")
