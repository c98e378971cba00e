"""Operator 2: quality rules with risk-controlled cutoffs.

Each rule compares one feature of a text, in ten-thousandths, with a cutoff. The cutoffs are chosen by stratum
(language) from the labelled good documents, the holdout. Every value that a feature takes among them is a
candidate. In each stratum ALPHA, the share of good documents that all rules together may reject, is divided
evenly among the rules; a candidate may be used only if an exact binomial test rejects, at a level divided among all strata
and rules (Bonferroni), that it rejects more than its share. Within a stratum and rule candidates are
tested from the most lenient on and the first failure ends the sequence, which needs no further correction; the
strictest that passed is used. With none, the rule does not judge that stratum. So with probability 1 - DELTA
no stratum loses more than ALPHA of its good documents to the rules.

Null and empty texts have no words and fail the base rules. A null stratum is a stratum of its own. Rows of
one id are judged each for itself and each counts as a holdout row; an id labelled more than once counts as its worst label, a null
id in the labels as none. Without labels, or with an empty table, only the base rules judge. Texts of any length are judged
whole. Other columns, whatever their names, are carried along by keep().

Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, Scratch, columns_of, let, whole_row

#: Share of a stratum's good documents that the rules may reject in all, and the probability that any stratum loses more.
ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT = 50, 50
SYMBOLS = "#*$%&|<>"
#: Features in ten-thousandths; a text fails a rule if its feature exceeds the cutoff.
RULES = ("symbol_share", "upper_share", "line_share", "repeat_share")
SCALE = 10_000


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are compared by 64-bit hash; those with a twin are found by sorting, and each adds the words that
    the one before it doesn't cover.
    """
    hashes = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))

    def twins(s):
        h = lambda k: F.get(s, k)["h"]
        return F.filter(s, lambda x, j: F.coalesce(F.when(j > 0, x["h"] == h(j - 1)), F.lit(False)) | F.coalesce(x["h"] == h(j + 1), F.lit(False)))

    def cover(at):
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(at, start, step, lambda a: a["n"])

    def count(h):
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        some = let(placed, lambda s: cover(F.sort_array(F.transform(twins(s), lambda x: x["i"]))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), some).otherwise(F.lit(0))

    return let(hashes, count)


def features(text: Column) -> Column:
    """A struct of the base counts and the rules' features of a text that isn't null."""
    length = lambda x: F.length(x).cast("long")
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    words = F.filter(F.split(text, SPACE + "+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def by_lines(x):
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    def by_words(x):
        return F.struct(F.size(x).cast("long").alias("n"), _repeated(x).cast("long").alias("rep"))

    def whole(p):
        n, chars, symbols = p["w"]["n"], p["chars"], p["symbols"]
        share = lambda a, b: F.when(b > 0, F.floor(SCALE * a / b)).otherwise(F.lit(0).cast("long"))
        return F.struct(
            n.alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"), p["l"]["dup"].alias("n_dup_lines"), p["w"]["rep"].alias("n_repeat_words"),
            ((n < MIN_WORDS) | (100 * p["w"]["rep"] > MAX_REPEAT * n)).alias("base_failed"),
            share(symbols, chars).alias("symbol_share"), share(p["upper"], p["letters"]).alias("upper_share"),
            share(p["l"]["dup"], p["l"]["n"]).alias("line_share"), share(p["w"]["rep"], n).alias("repeat_share"),
        )

    parts = F.struct(
        let(words, by_words).alias("w"), let(lines, by_lines).alias("l"), length(bare).alias("chars"),
        (length(text) - length(F.translate(text, SYMBOLS, ""))).alias("symbols"),
        length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("upper"), length(F.regexp_replace(text, r"\P{L}+", "")).alias("letters"),
    )
    return let(parts, whole)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series of n + 8, taken back over eight factors; exact to double precision."""
    x = n + 9.0
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5))) - 1 / (1680 * F.pow(x, F.lit(7)))
    whole = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series
    for k in range(1, 9):
        whole = whole - F.log(n + float(k))
    return whole


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of X ~ Bin(n, p), summed downwards from k; terms beyond 40 standard deviations are zero in double precision."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    low = F.greatest(F.lit(0), (k - 40 * F.sqrt(n * p * (1 - p)) - 40).cast("int"))
    ratio = (1 - p) / p
    start = F.struct(top.alias("term"), top.alias("sum"))

    def step(a, i):
        term = a["term"] * i / (n - i + 1) * ratio
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    down = F.when(k > low, F.sequence(k.cast("int"), low + 1, F.lit(-1))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(down, start, step, lambda a: a["sum"])


def least_labels(alpha: float = ALPHA, delta: float = DELTA) -> int:
    """Good labels without which no cutoff can pass, whatever the number of strata."""
    return math.ceil(math.log(delta / len(RULES)) / math.log1p(-alpha / len(RULES)))


def candidates(judged: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, rule, value, n, over, bound, passes for every value of every rule among the holdout rows.

    over counts the holdout rows beyond the value, bound is the level at which the binomial test finds them few
    enough. A rule has SCALE + 1 values at most, so the windows hold no more rows than that, whatever the input.
    """
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])
    counts = judged.select("stratum", F.inline(pairs)).groupBy("stratum", "rule", "value").agg(F.count(F.lit(1)).alias("c"))
    each = Window.partitionBy("stratum", "rule")
    beyond = each.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.select("stratum", "rule", "value", F.sum("c").over(each).alias("n"), F.coalesce(F.sum("c").over(beyond), F.lit(0).cast("long")).alias("over"))
    rows = rows.where(F.col("n") >= least_labels(alpha, delta))
    strata = judged.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_labels(alpha, delta)).agg(F.count(F.lit(1)).alias("strata"))
    share = alpha / len(RULES)
    # Beyond the mean of the binomial the bound is over a third, which no level allows.
    bound = F.when(F.col("over") <= F.col("n") * share, binomial_tail(F.col("over"), F.col("n"), share)).otherwise(1.0)
    return rows.withColumn("bound", bound).withColumn("level", F.lit(delta) / (len(RULES) * strata.scalar())).withColumn("passes", F.col("bound") <= F.col("level"))


def report(judged: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff and, of it, n holdout rows, rejected ones among them, bound and level."""
    best = F.min_by(F.struct("value", "n", "over", "bound", "level"), "value").alias("b")
    rows = candidates(judged, alpha, delta).where("passes").groupBy("stratum", "rule").agg(best)
    return rows.select("stratum", "rule", F.col("b.value").alias("cutoff"), F.col("b.n").alias("n"), F.col("b.over").alias("rejected"), F.col("b.bound").alias("bound"), F.col("b.level").alias("level"))


def cutoffs(judged: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum and a cutoff for each rule (null: none passed), from rows of labelled good documents with their features.

    A row needs least_labels() documents, so there are at most that part of the labels as rows.
    """
    cut = [F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]
    return report(judged, alpha, delta).groupBy("stratum").agg(*cut)


def measured(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """doc_id, stratum and the features of every row, beside the whole row."""
    f = features(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"), f.alias("f"))
    return rows.select("row", "doc_id", "stratum", "f.*")


def holdout(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The measured rows that the base rules pass and that are labelled good."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    return rows.where(~F.col("base_failed")).join(good.select("doc_id"), "doc_id").select("stratum", *RULES)


def verdict(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """rows with kept: not failed by the base rules, nor by a rule that has a cutoff in the row's stratum.

    cuts is a written table, so Spark broadcasts it only where its size allows; strata are few.
    """
    failed = F.col("base_failed")
    for r in RULES:
        failed = failed | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    return rows.join(cuts, "stratum", "left").withColumn("kept", ~failed)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, the base counts, base_failed, kept; a row for each row of docs."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.write(measured(docs, id_col, text_col, stratum_col).drop("row"), "rows")
    cuts = scratch.write(cutoffs(holdout(rows, labels)), "cuts")
    return verdict(rows, cuts).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of docs that judge() keeps, with their own columns.

    Rows are written with their features once, which is cheaper than features computed twice or texts shuffled.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.write(measured(docs, id_col, text_col, stratum_col), "rows")
    cuts = scratch.write(cutoffs(holdout(rows, labels)), "cuts")
    return verdict(rows, cuts).where("kept").select(*columns_of(docs))
