"""Operator 7: secret scans with multipart credential linking.

Three kinds of spans are always reported (assign, access, hex). Weak candidates of further kinds are not: an
account name (ident), a mail address, a web address (endpoint), a numeric host, a long mixed run (blob). They are
reported only where a complementary part of a credential lies within SCOPE characters of them in the same text:
a blob next to an identifier (access, ident, mail), all others next to a secret (assign, blob, hex with letters and digits).

Parts of one credential are different characters. A weak span that overlaps a reported kind, or a weak one listed before it, is none; only an
endpoint may hold other parts. An assign or hex span that overlaps an access span is that identifier, no secret.

The interval join of a text's parts with each other is a running greatest end of those before and a running
least start of those after each part, so neighbours are never paired and the work grows with the number of
spans. Nothing but span lengths is shuffled, and only of texts that hold any. Null texts count as empty and an
empty table gives no rows. Repeated rows and rows of one id stay apart, each with its spans. Spans that start together
are listed in the order of KINDS. Texts of any length are searched whole; other columns go no further.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, id_and_text, let
from .pii import PATTERNS

#: Characters between linked parts, from the end of the earlier to the start of the later.
SCOPE = 400
_RUN = "A-Za-z0-9+/_.=-"
#: kind: pattern, group and characters that the group must have; in the order in which equal starts are listed.
KINDS = {
    "assign": (rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([{_RUN}]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
    "ident": (r"""(?i:user(?:name)?|login|account|client_?id|tenant_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 1, 3),
    "endpoint": (r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+", 0, 10),
    "mail": (PATTERNS["mail"], 0, 6),
    "host": (PATTERNS["address"] + r"(?::\d{1,5}(?!\d))?", 0, 7),
    "blob": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}+", 0, 32),
}
BASE = ("assign", "access", "hex")
IDENTIFIERS, SECRETS = ("access", "ident", "mail"), ("assign", "hex", "blob")
#: What a match must hold besides, to be a part: a blob small and capital letters and digits; a hex run letters and digits, to be a secret.
MIXED = {"hex": r"^(?=.*[0-9])(?=.*[a-f])", "blob": r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"}


def _parts(text: Column, kind: str) -> Column:
    """(rank, i, gap before the match, its length, whether it counts, whether it is mixed) of every match of a kind, in order."""
    pattern, group, least = KINDS[kind]
    rank = list(KINDS).index(kind)

    def rows(m):
        gaps = F.split(text, pattern, -1)
        length = lambda x: F.length(F.regexp_extract(x, pattern, group) if group else x)
        mixed = lambda x: x.rlike(MIXED[kind]) if kind in MIXED else F.lit(True)
        counts = lambda x: (length(x) >= least) & (mixed(x) if kind == "blob" else F.lit(True))
        return F.transform(
            F.arrays_zip(m.alias("m"), F.slice(gaps, F.lit(1), F.size(m)).alias("g")),
            lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), counts(x["m"]).alias("counts"), mixed(x["m"]).alias("mixed")),
        )

    none = F.expr("cast(array() as array<struct<rank:int,i:int,gap:int,size:int,counts:boolean,mixed:boolean>>)")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, rows(m)).otherwise(none))


def _kinds() -> Column:
    return F.array(*[F.lit(k) for k in KINDS])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """(rows, found): a key and doc_id of every row of docs; key, kind, start, end of every reported span.

    Null texts count as empty. Keys are written down once, so repeated rows stay apart and each has its spans.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    texts = id_and_text(docs, id_col, text_col)
    parts = F.flatten(F.array(*[_parts(F.col("text"), k) for k in KINDS]))
    rows = scratch.write(texts.select(F.monotonically_increasing_id().alias("key"), "doc_id", parts.alias("parts")), "rows")
    flat = rows.where(F.size("parts") > 0).select("key", F.inline("parts"))
    before = Window.partitionBy("key", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)).where("counts").withColumn("start", F.col("end") - F.col("size"))
    placed = placed.withColumn("kind", F.get(_kinds(), F.col("rank"))).drop("rank", "i", "gap", "size", "counts")
    # Both frames grow from their beginning, so a text's spans are gone through once in each direction.
    upto = Window.partitionBy("key").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("key").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    kind = F.col("kind")

    def around(of: Column) -> tuple[Column, Column]:
        """The greatest end of such spans up to a span's start, the least start of those from there on."""
        return F.max(F.when(of, F.col("end"))).over(upto), F.min(F.when(of, F.col("start"))).over(down)

    def overlaps(of: Column) -> Column:
        end, start = around(of)
        return F.coalesce(end > F.col("start"), F.lit(False)) | F.coalesce(start < F.col("end"), F.lit(False))

    def near(of: Column) -> Column:
        end, start = around(of)
        return F.coalesce(F.col("start") - end <= scope, F.lit(False)) | F.coalesce(start - F.col("end") <= scope, F.lit(False))

    base = kind.isin(*BASE)
    parts = placed.withColumns({"by_access": overlaps(kind == "access") & (kind != "access"), "by_base": overlaps(base) & ~base})
    parts = parts.where(~((kind == "ident") & F.col("by_base")))
    parts = parts.withColumn("by_named", overlaps(base | kind.isin("ident", "endpoint")) & kind.isin("mail", "host"))
    parts = parts.where(~F.col("by_named"))
    parts = parts.withColumn("by_any", overlaps(kind != "blob") & (kind == "blob")).where(~F.col("by_any"))
    secret = kind.isin(*SECRETS) & F.col("mixed") & ~F.col("by_access")
    linked = parts.withColumns({"has_id": near(kind.isin(*IDENTIFIERS)), "has_secret": near(secret)})
    reported = base | F.when(kind == "blob", F.col("has_id")).otherwise(F.col("has_secret"))
    linked = linked.withColumn("rank", F.array_position(_kinds(), kind) - 1)
    return rows.select("key", "doc_id"), linked.where(reported).select("key", "rank", "kind", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: a row for each row of docs.

    Spans are kind:start:end in code points, by start and then kind as listed in KINDS, joined by commas.
    """
    rows, found = spans(docs, id_col, text_col, scope)
    ordered = F.array_sort(F.collect_list(F.struct("start", "rank", F.concat_ws(":", "kind", "start", "end").alias("text"))))
    by = found.groupBy("key").agg(*[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in BASE], ordered.alias("all"))
    joined = rows.join(by, "key", "left")
    texts = lambda x: F.array_join(F.transform(x, lambda s: s["text"]), ",")
    none = F.lit("")
    base = F.coalesce(texts(F.filter("all", lambda s: s["rank"] < len(BASE))), none)
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE], F.sha2(base, 256).alias("base_sha256"), F.coalesce(texts(F.col("all")), none).alias("spans"))
