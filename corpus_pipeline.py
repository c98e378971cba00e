"""The corpus pipeline: quality rules, line de-duplication, one text of each near-duplicate class, surrogates for
personal data, packing. Each stage takes what its predecessor kept; all but the last return the columns of
documents alone, whatever others come in, with n_chars brought up to date where texts change.

Null texts fail the quality rules, and count as empty ones in the later stages but for surrogates, which leave them null.
Of repeated rows all stay until near-duplicates, which keep one. Null ids are kept apart by their texts. Ties go to the least
id. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import line_dedup, ngram_join, packing, pii, quality
from foliant.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the calibrated cutoffs keep."""
    return quality.keep(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def deduplicated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the long lines that other documents hold; texts may become empty."""
    docs = docs.select(*COLUMNS)
    return _as_documents(line_dedup.apply(docs, line_dedup.keep_bitmaps(docs)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the least doc_id."""
    return ngram_join.keep_one(docs.select(*COLUMNS))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced, under the session's key."""
    return _as_documents(pii.replace(docs.select(*COLUMNS), pii.session_key(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences along the curve."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", deduplicated_lines),
    ("ngram_join", one_of_each),
    ("pii_surrogates", surrogates),
    ("packing", packed),
]

#: MinHash candidates and the space-filling curve are not SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir, each stage written down before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs, name)
    return docs
