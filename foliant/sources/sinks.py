"""Writers of works, lists, ledgers, summaries and reports (K1 to K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import file_stem
from ..operators.titles import blank, raw_type_allowed


def stage_works(records: DataFrame, existing: DataFrame, key: str = "doi") -> DataFrame:
    """Records with `status`: Cached if the key is stored, Filtered by raw type or blank title, else Success."""
    stored = existing.select(key).distinct().withColumn("__stored", F.lit(True))
    rows = records.join(stored, key, "left")
    passes = raw_type_allowed(F.col("type")) & ~blank(F.col("title"))
    return rows.withColumn("status", F.when(F.col("__stored"), "Cached").when(passes, "Success").otherwise("Filtered")).drop("__stored")


def enveloped(record: Column, status: str = "ok", kind: str = "work", version: str = "1.0.0") -> Column:
    """The envelope in which single works come."""
    return F.struct(F.lit(status).alias("status"), F.lit(kind).alias("message-type"), F.lit(version).alias("message-version"), record.alias("message"))


def save_works(staged: DataFrame, path: str, ledger: str, key: str = "doi") -> None:
    """K1, K2, K4: append the successes as JSON, `file` naming each, and the keys of filtered ones to the ledger."""
    staged.where("status = 'Success'").drop("status").withColumn("file", file_stem(F.col(key))).write.mode("append").json(path)
    append_ledger(staged.where("status = 'Filtered'"), ledger, key)


def write_doi_lists(rows: DataFrame, path: str) -> None:
    """K3: lists of DOIs in folders by issn and year; a folder's rows come from as many tasks as its size asks for."""
    rows.select("issn", "year", "doi").hint("rebalance", "issn", "year").write.mode("overwrite").partitionBy("issn", "year").text(path)


def append_ledger(rows: DataFrame, path: str, key: str = "doi") -> None:
    """K4: one key a line."""
    rows.select(F.col(key).cast("string").alias("value")).where("value is not null").write.mode("append").text(path)


def without_markers(ledger: DataFrame, gone: DataFrame, key: str = "doi") -> DataFrame:
    """K4: the ledger without the keys of gone, to be written anew."""
    return ledger.join(gone.select(key).distinct(), key, "left_anti")


def write_summary(df: DataFrame, path: str) -> None:
    """K5: truncate and insert."""
    df.write.mode("overwrite").parquet(path)


def write_log(actions: DataFrame, path: str) -> None:
    """K6: one JSON object a line, NULL values written out."""
    actions.write.mode("append").option("ignoreNullFields", "false").json(path)


def report(actions: DataFrame, column: str = "action") -> DataFrame:
    """K6, K8: column, n for every outcome."""
    return actions.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
