"""Queries of the text operators over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, filter_audit, hmm, lexical, line_dedup, media, ngram_join, packing, pii, quality, secrets, sql, suffix_dedup, token_counts
from .common import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_hmm_scoring(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_pii_surrogates(spark, sf_dir):
    found = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))
    return found.select("doc_id", F.col("__n_entities").alias("n_entities"), "text")


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op5_media_columns(spark, sf_dir):
    return media.stored_features(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@query
def op7_secret_scans(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_ngram_join(spark, sf_dir):
    return ngram_join.classes(table(spark, sf_dir, "documents")).drop("tag")


@query
def op10_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op11_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    n_removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    return found.select("doc_id", "n_bytes", n_removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_lexical_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES |= {"op12_filter_audit": sql.FILTER_AUDIT, "op13_lexical_search": sql.LEXICAL_SEARCH}
ORACLES |= {"op2_quality_rules": sql.quality_rules(), "op8_line_dedup": sql.LINE_DEDUP}
