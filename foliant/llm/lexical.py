"""Operator 13: ranked lexical search by TPUT over term-partitioned postings.

A list holds the documents of one term with their impacts, the term's weight left out. Lists are dealt to partitions by
ranges of (term, impact), so a word of every other document spreads over many partitions. The three phases of the
uniform threshold algorithm are joins over all queries at once:

1. The k heads of each list give partial scores. The exact scores of the best few documents by these are looked up; the
   k-th of them is a lower bound of the query's k-th score.
2. One threshold for all lists of a query: the least at which a document that reaches it in no list stays below the bound, a
   list giving no more than its head. What is at or above it is fetched from each list. The best documents by what was
   fetched are looked up for a better bound; a document that stays below it even with all that the other lists could add is dropped.
3. Exact scores of the rest: the lists that were not fetched for a document are looked up by term and document.

Of a frequent word with a small weight little more than the heads is read for a query whose bound is beyond it. All scores are
integers, so neither order nor partitioning can change a result.

Null and empty texts have no terms; such documents are not counted, such queries find nothing. Repeated rows of the
documents are documents of their own; a query row found twice is answered once, and two texts of one query id are
answered each for itself. Ties go to the lesser id, null ids last. Texts are read whole, in batches bounded by bytes.
An empty table gives no rows. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, map_arrow

#: Documents of a result, and how many times as many are looked up for the first bound, which any number keeps exact.
TOP, PROBED = 10, 8
#: Of the greatest threshold that loses no document so much is taken: a lower one fetches more, and leaves less to look up.
SHARE = 0.25
#: Distinct query terms up to which workers get them to leave other terms out early; beyond, the join alone does it.
SENT_TERMS = 200_000
#: Query terms that the tables of queries hold in a file: in a file a partition, a few rows each, they would seem too large to be sent to all tasks.
TERMS_A_FILE = 200_000
#: ASCII letters in lower case and digits stay, other ASCII becomes a space, bytes of other characters stay.
_TERMS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    """The runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_TERMS).split()


def _postings(only: frozenset | None):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("term", pa.string()), ("tf", pa.int64()), ("n", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        for b in batches:
            rows, words, counts, sizes = [], [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                found = terms(text)
                if not found:
                    continue
                count = Counter(found)
                mine = count.keys() if only is None else [t for t in count if t in only]
                rows += [k] * (len(mine) + 1)
                words += [None, *mine]
                counts += [len(found), *map(count.__getitem__, mine)]
                sizes += [len(found)] * (len(mine) + 1)
            rows = np.array(rows, np.int64)
            words = pa.array(words, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(rows + at), b.column("id").take(pa.array(rows)), words, pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], schema=schema)
            at += b.num_rows

    return run


def postings(docs: DataFrame, only: frozenset | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, id, term, tf, n: a row for each document with terms (term null, tf = n) and for each of its terms (of those in only)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_arrow(texts, _postings(only), "key long, id long, term string, tf long, n long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _best(scores: DataFrame, k: int) -> DataFrame:
    return scores.withColumn("at", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "key"))).where(F.col("at") <= k)


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """item, bound: the k-th best score of each item, 0 where it has fewer."""
    return _best(scores, k).groupBy("item").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(0).cast("long").alias("bound"))


def _looked_up(lists: DataFrame, pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """item, key, score: the exact scores of pairs (item, key, a written table).

    The postings of these documents meet their queries by document, so that each sum is formed where its rows are.
    """
    mine = lists.join(pairs.select("item", "key"), "key").join(wanted, ["item", "term"])
    return mine.groupBy("key", "item").agg(F.sum(F.col("c") * F.col("impact")).alias("score"))


def rank(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query with a score above 0.

    A term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's m = 25 + (75 n N) div L, and it scores
    w ((10^9 tf) div (1000 tf + 8 m)) for each occurrence of the term in the query.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    asked = queries.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(query_col), F.lit("")).alias("text")).distinct()
    items = scratch.write(asked.withColumn("item", F.xxhash64("item_id", "text")), "items")
    wanted = scratch.write(postings(items, None, "item").where("term is not null").select(F.col("id").alias("item"), "term", F.col("tf").alias("times")), "wanted")
    files = 1 + wanted.count() // TERMS_A_FILE
    vocabulary = wanted.select("term").distinct()
    only = frozenset(r.term.encode() for r in vocabulary.collect()) if vocabulary.count() <= SENT_TERMS else None
    raw = scratch.write(postings(docs, only, id_col, text_col), "raw")

    stats = scratch.write(raw.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), "stats")
    whole = stats.where("term is null").head()
    n_docs, n_terms = (whole.df, whole.total) if whole else (0, 1)
    weight = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = stats.where("term is not null").join(vocabulary, "term").select("term", weight.alias("w")).where("w > 0")
    wanted = scratch.write(wanted.join(weights, "term").select("item", "term", (F.col("times") * F.col("w")).alias("c")).coalesce(files), "weighed")
    m = 25 + _div(75 * F.col("n") * n_docs, F.lit(n_terms).cast("long"))
    impact = _div(F.lit(10**9).cast("long") * F.col("tf"), 1000 * F.col("tf") + 8 * m)
    sought = scratch.write(wanted.select("term").distinct().coalesce(files), "terms")
    held = raw.where("term is not null").join(sought, "term", "left_semi")
    lists = held.select("term", impact.alias("impact"), "key").repartitionByRange("term", F.desc("impact"), "key").sortWithinPartitions("term", F.desc("impact"))
    lists = scratch.write(lists, "lists")

    # Phase 1: heads.
    best = Window.partitionBy("term").orderBy(F.desc("impact"), "key")
    heads = scratch.write(lists.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).drop("at"), "heads")
    first = heads.join(wanted, "term").groupBy("item", "key").agg(F.sum(F.col("c") * F.col("impact")).alias("score"))
    probed = scratch.write(_best(first, PROBED * k).select("item", "key"), "probed")
    bounds = scratch.write(_kth(_looked_up(lists, probed, wanted), k), "bounds")
    top = heads.groupBy("term").agg(F.max("impact").alias("top"))
    heights = wanted.join(top, "term").select("item", "term", "c", (F.col("c") * F.col("top")).alias("top"))
    heights = heights.join(bounds, "item", "left").withColumn("bound", F.coalesce("bound", F.lit(0).cast("long")))
    # With the j lowest lists up to their heads and the others up to x, the sum stays below the bound if x is at most (bound - 1 - heads) / others, for any j.
    query = Window.partitionBy("item").orderBy("top", "term")
    lower = F.coalesce(F.sum("top").over(query.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    others = F.count(F.lit(1)).over(Window.partitionBy("item")) - F.row_number().over(query) + 1
    below = heights.withColumn("x", F.floor((F.col("bound") - 1 - lower) / others)).groupBy("item").agg(F.floor(F.greatest(F.lit(0).cast("long"), F.max("x")) * SHARE).alias("below"))
    plan = heights.join(below, "item").select("item", "term", "c", _div(F.col("below") + F.col("c"), F.col("c")).alias("least"), F.least("below", "top").alias("rest"), "top", "bound")
    plan = scratch.write(plan.coalesce(files), "plan")

    # Phase 2: everything at or above the uniform threshold. What was fetched is dealt by document; the sums of all queries are formed there.
    steps = plan.where(F.col("least") * F.col("c") <= F.col("top"))
    floors = scratch.write(steps.groupBy("term").agg(F.min("least").alias("floor")).coalesce(files), "floors")
    near = lists.join(floors, "term").where("impact >= floor").select("term", "key", "impact").repartition("key")
    sums = near.join(steps, "term").where("impact >= least").groupBy("key", "item").agg(F.sum(F.col("c") * F.col("impact")).alias("score"), F.sum("rest").alias("seen"))
    limits = scratch.write(plan.groupBy("item").agg(F.sum("rest").alias("rest"), F.first("bound").alias("bound")).coalesce(files), "limits")
    fetched = sums.join(limits, "item").select("item", "key", "score", (F.col("score") + F.col("rest") - F.col("seen")).alias("most"), "bound").where("most >= bound")
    fetched = scratch.write(fetched, "fetched")
    better = scratch.write(_best(fetched, PROBED * k).select("item", "key"), "better")
    second = _kth(_looked_up(lists, better, wanted), k).unionByName(limits.select("item", "bound")).groupBy("item").agg(F.max("bound").alias("second"))
    second = scratch.write(second.coalesce(files), "second")
    hopeful = scratch.write(fetched.join(second, "item").where("most >= second").select("item", "key"), "hopeful")

    # Phase 3: exact scores of the documents that may still be among the best.
    exact = _looked_up(lists, hopeful, wanted).where("score > 0")
    named = raw.where("term is null").select("key", "id").join(exact, "key")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    ranked = scratch.write(named.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k), "ranked")
    scratch.drop("raw", "lists", "stats", "heads", "probed", "bounds", "plan", "limits", "fetched", "better", "second", "hopeful")
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
