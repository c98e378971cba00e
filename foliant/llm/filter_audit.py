"""Operator 12: filter interaction audit over the trie of all orders of some filters.

Every order of the filters is a path of the permutation trie. What survives a prefix depends only on which filters
it holds, so prefixes that hold the same ones share one state: the walk goes depth first, persists the survivors of
each state it meets first, counts on them what each further filter removes (the edges out of the state), applies that
filter to them for the next state, and releases them when all states below are done. Of five filters there are 31
states with survivors to count instead of 325 prefixes, and five persisted tables at a time at most.

Each filter judges a document by the table as it was given, so a verdict is found once a document; the states hold
the part, the verdicts and the two labels, no texts. Counts by part stay tables; nothing is collected. An executor
that is lost takes persisted blocks with it, which Spark makes anew from the written table of verdicts.

Null and empty texts have no words: they are short, and identical to each other. A null part is ''. Null ids are never
larger than another id and bear no label. Repeated rows count each for itself, and are no copies of each other. An id
labelled more than once is good if all its labels say so and toxic if any does. An empty table has no parts and no
rows. Texts are judged whole; copies are compared by SHA-256. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, let

MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 100, 80, 10
MARKS = r"[#$%&*|]"


def _words(text: Column, body) -> Column:
    return let(F.filter(F.split(text, SPACE + "+"), lambda x: x != ""), body)


def _few_distinct(words: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words)


def text_filters(text: Column) -> dict[str, Column]:
    """Whether a text that isn't null fails: A, too few words; B, too few distinct ones; C, too many capitals; D, marks."""
    by_words = _words(text, lambda w: F.struct((F.size(w) < MIN_WORDS).alias("A"), _few_distinct(w).alias("B")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": by_words["A"], "B": by_words["B"], "C": 100 * capitals > MAX_UPPER * F.length(text), "D": text.rlike(MARKS)}


def verdicts(docs: DataFrame, labels: DataFrame, filters: Callable[[Column], dict[str, Column]] = text_filters, copies: str | None = "E", id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> tuple[DataFrame, list[str]]:
    """part, good, toxic and a boolean for each filter, true where the document fails it; and the filters' names.

    copies names the filter that fails texts identical to the text of a smaller id, None leaves it out. The least id of
    each repeated text is written down before it is joined, so that the rows of a hot text are split, not sent to one task.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    failed = filters(text)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("h"), F.struct(*[v.alias(k) for k, v in failed.items()]).alias("f"),
    )
    rows = scratch.write(rows.select("id", "part", "h", "f.*"), "rows")
    least = scratch.write(rows.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("top")).where("least < top").drop("top"), "least")
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.min("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    names = list(failed)
    if copies:
        rows = rows.join(least, "h", "left").withColumn(copies, F.coalesce(F.col("least") < F.col("id"), F.lit(False)))
        names.append(copies)
    rows = rows.join(marked, "id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    out = scratch.write(rows.select("part", *flags, *[F.coalesce(c, F.lit(False)).alias(c) for c in names]), "verdicts")
    scratch.drop("rows", "least")
    return out, names


def edges(rows: DataFrame, names: list[str], scratch: Scratch) -> DataFrame:
    """part, state, filter, before, removed, good, toxic: a row for each edge of the trie's shared states and part with survivors.

    state has bit k set where filter k was applied before; before counts the survivors there.
    """
    done, full = set(), (1 << len(names)) - 1
    # The same sums in every state, so that Spark compiles them once; a filter that was applied before removes nothing.
    sums = [
        F.count_if(c).alias(f"{what}{k}")
        for k, f in enumerate(names)
        for what, c in (("removed", F.col(f)), ("good", F.col(f) & F.col("good")), ("toxic", F.col(f) & F.col("toxic")))
    ]

    def walk(state: int, survivors: DataFrame) -> None:
        if state in done or state == full:
            return
        done.add(state)
        survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        scratch.write(survivors.groupBy("part").agg(F.count(F.lit(1)).alias("before"), *sums), f"edges/state={state}")
        for k, f in enumerate(names):
            if not state >> k & 1:
                walk(state | 1 << k, survivors.where(~F.col(f)))
        survivors.unpersist()

    walk(0, rows)
    out = [F.struct(F.lit(k).alias("k"), F.lit(f).alias("filter"), *[F.col(f"{n}{k}").alias(n) for n in ("removed", "good", "toxic")]) for k, f in enumerate(names)]
    found = rows.sparkSession.read.parquet(scratch.path("edges")).select("part", F.col("state").cast("int").alias("state"), "before", F.inline(F.array(*out)))
    return found.where(F.getbit(F.col("state"), F.col("k")) == 0).drop("k")


def audit(rows: DataFrame, names: list[str]) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every order of names.

    rows: part, good, toxic and a boolean for each name, true where a row fails that filter.
    """
    spark, n, every = rows.sparkSession, len(names), (1 << len(names)) - 1
    found = edges(rows, names, Scratch(spark, "trie"))
    bits = F.create_map(*[x for k, f in enumerate(names) for x in (F.lit(f), F.lit(1 << k))])
    size = F.bit_count("state")
    ways = F.get(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), size)
    by_filter = found.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("state") == 0, F.col("removed")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("state") == F.lit(every) - bits[F.col("filter")], F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * ways).alias("shapley"),
    )
    steps = []
    for order in itertools.permutations(range(n)):
        name, state = "".join(names[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append((name, step, state, names[k]))
            state |= 1 << k
    orders = spark.createDataFrame([(at, *s) for at, s in enumerate(steps)], "at int, filter_order string, step int, state int, filter string")
    parts = by_filter.select("part", "filter", "fails", "unique_fails", "shapley")
    # One row for each part and filter meets the steps that end in that filter; a part without survivors at an edge removes nothing there.
    laid = parts.join(orders, "filter").join(found, ["part", "state", "filter"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return laid.select(
        "part", "filter_order", "step", (zero("before") - zero("removed")).alias("kept"), zero("removed").alias("removed"), (F.col("fails") - zero("removed")).alias("redundant"),
        "unique_fails", zero("good").alias("good_lost"), zero("toxic").alias("toxic_lost"), "shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """audit() of the five filters A to E over docs; how as in verdicts()."""
    return audit(*verdicts(docs, labels, **how))
