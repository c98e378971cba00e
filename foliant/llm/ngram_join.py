"""Operator 9: n-gram Jaccard join.

Texts with one and the same set of five-word shingles form a node. MinHash signatures are banded, with bands
and rows chosen for a target recall; rows of a band's hash meet in a shuffle, which yields one edge from each
node to the bucket's least node, never all pairs. The components of these edges hold every candidate pair.

Within a component pairs are verified on the full shingle sets, block against block. Nodes are sorted into size
steps, such that sets two steps apart differ in size by more than any similar pair can; so a block meets only
blocks of its own step and of the next, which loses no link. A task's blocks hold at most BLOCK nodes and about
SHINGLES shingles; it counts each node's links and returns one edge a node for its linked neighbourhood. The
meetings of a component are numbered and dealt to partitions in turn, so a large group of near copies spreads
evenly, and no pair is ever emitted. The components of the verified edges are the classes.

Null and empty texts, and those of white space alone, have no shingles and no links; each is a class of its own.
Texts of fewer than five words have one shingle, all their words. Rows with equal texts, repeated rows too, are
copies of each other and count as links. Ties: a class is named after its least id, null ids counting as
larger than all others. Null ids take part like any other; a class of null ids alone is named null. An empty
table has no classes. Very long texts are cut into shingles whole, in batches bounded by bytes. Other columns, whatever
their names, are carried along by keep_one().
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, Scratch, columns_of, id_and_text, map_arrow, whole_row
from .components import components

WORDS, SIMILAR, RECALL, ROWS = 5, 0.8, 0.9999, 8
#: Nodes of a block at most and at least, and about how many shingles it may hold; a task compares two blocks. Up to SPREAD blocks
#: of SMALL nodes or more come before blocks grow, so that groups of middle size spread over many tasks too.
BLOCK, LEAST, SHINGLES, SMALL, SPREAD = 512, 16, 4_000_000, 64, 16


def bands_for(similar: float = SIMILAR, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of so many rows with which a pair of the least similarity shares a bucket with probability recall."""
    return math.ceil(math.log(1 - recall) / math.log1p(-(similar**rows)))


class _Hashes(dict):
    def __missing__(self, word):
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 100_000:
            self[word] = h
        return h


def shingles(text: str, hashes: dict, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words (ASCII lower case); of all words where there are fewer."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    x = ((x ^ (x >> np.uint64(32))) * np.uint64(0xDABA0B6EB09322E3)) >> np.uint64(32)
    return (x[:count] | np.uint64(1)).astype(np.uint32), x[count:].astype(np.uint32)


def band_hashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash of each band of the signature, the band's number included."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(low, (x[k : k + 256, None] * a + b).min(0), out=low)
    out = np.arange(1, len(a) // rows + 1, dtype=np.uint64)
    for column in low.reshape(-1, rows).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def _signatures(rows: int, bands: int):
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        from pyspark import TaskContext

        hashes, (a, b_) = _Hashes(), permutations(rows * bands)
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            n, sets, found = b.num_rows, [], []
            for text in b.column("text").to_pylist():
                grams = shingles(text, hashes)
                sets.append((*np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), "<i8").tolist(), len(grams)))
                found.append(band_hashes(grams, a, b_, rows).view(np.int64) if len(grams) else [])
            cols = [np.arange(at, at + n), b.column("doc_id"), b.column("tag"), *([x[k] for x in sets] for k in range(3)), found]
            at += n
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


#: What a task needs to know of a node: its component, size step, and the blocks of its step, of the one below and of the one above.
_MEMBER = ("node", "root", "weight", "step", "blocks", "below", "above")


def _sets(batches):
    schema = pa.schema([*((c, pa.int64()) for c in _MEMBER), ("grams", pa.binary())])
    hashes = _Hashes()
    for b in batches:
        grams = pa.array([shingles(t, hashes).tobytes() for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _MEMBER), grams], schema=schema)


def linked(sets: list[np.ndarray], similar: float, left: int = 0) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of at least similar; nothing is linked to itself.

    With left, only the first so many (rows) are compared with the rest (columns).
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column, width = owner[keep], place[column[keep]], int(shared.sum())
    rows, cols = (slice(0, left), slice(left, n)) if left else (slice(0, n), slice(0, n))
    both = np.zeros((left or n, n - left), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, width, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        x = np.zeros((n, min(4096, width - low)), np.float32)
        x[owner[a:b], column[a:b] - low] = 1
        both += x[rows] @ x[cols].T
    out = (both >= similar * (sizes[rows, None] + sizes[None, cols] - both) - 1e-4) & (both > 0)
    if not left:
        np.fill_diagonal(out, False)
    return out


_NONE = np.iinfo(np.int64).max


def _answer(nodes: list[tuple], similar: float, two: bool):
    """ids, links and least reachable ids of the nodes (id, weight, side, set) of one meeting that have links.

    two: only nodes of different sides are compared. None if there is nothing to compare.
    """
    nodes.sort(key=lambda v: v[2])
    left = sum(v[2] == 0 for v in nodes) if two else 0
    if len(nodes) < 2 or two and left in (0, len(nodes)):
        return None
    ids, weights = np.array([v[0] for v in nodes]), np.array([v[1] for v in nodes])
    pairs = linked([v[3] for v in nodes], similar, left)
    rows, cols = (slice(0, left), slice(left, None)) if two else (slice(None), slice(None))
    least, links = ids.copy(), np.zeros(len(ids), np.int64)
    links[cols] += weights[rows] @ pairs
    if two:
        links[rows] += pairs @ weights[cols]
    while True:
        new = least.copy()
        new[cols] = np.minimum(new[cols], np.where(pairs, least[rows, None], _NONE).min(0, initial=_NONE))
        new[rows] = np.minimum(new[rows], np.where(pairs, new[None, cols], _NONE).min(1, initial=_NONE))
        if (new == least).all():
            break
        least = new
    some = links > 0
    return ids[some], links[some], least[some]


def _verify(similar: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("b", pa.int64())])
    names = ("root", "step", "across", "i", "j", "node", "weight", "side", "grams")

    def run(batches):
        group, nodes = None, {}
        ended = lambda: _answer(list(nodes.values()), similar, bool(group[2] or group[3] != group[4])) if group else None
        for b in batches:
            out = []
            for *g, node, weight, side, grams in zip(*(b.column(c).to_pylist() for c in names)):
                if g != group:
                    out.append(ended())
                    group, nodes = g, {}
                nodes[node] = (node, weight, side, np.frombuffer(grams, np.uint64))  # once, however often its row is repeated
            if out := [x for x in out if x is not None]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], schema=schema)
        if (x := ended()) is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in x], schema=schema)

    return run


def steps_of(grouped: DataFrame, similar: float) -> DataFrame:
    """grouped (root, n, ...) with step, blocks, below and above.

    A similar pair differs by a factor of 1 / similar at most, so by one step at most; the margin in the width is
    far above rounding errors. A component has as many steps as doublings of size, times three: the window is small.
    """
    width = -math.log(similar) * (1 + 1e-9)
    rows = grouped.withColumn("step", F.floor(F.log(F.col("n").cast("double")) / width))
    held = F.greatest(F.lit(LEAST), F.floor(SHINGLES / F.exp((F.col("step") + 1) * width)))
    per = F.least(F.lit(BLOCK), held, F.greatest(F.lit(SMALL), F.ceil(F.col("c") / SPREAD)))
    counts = rows.groupBy("root", "step").agg(F.count(F.lit(1)).alias("c")).withColumn("blocks", F.ceil(F.col("c") / per).cast("long"))
    by = Window.partitionBy("root").orderBy("step")
    near = lambda f, d: F.coalesce(F.when(f("step", 1).over(by) == F.col("step") + d, f("blocks", 1).over(by)), F.lit(0).cast("long"))
    return rows.join(counts.select("root", "step", "blocks", near(F.lag, -1).alias("below"), near(F.lead, 1).alias("above")), ["root", "step"])


def meetings(sets: DataFrame) -> DataFrame:
    """A row for each node and meeting of its block: root, step, across, i, j, at (the meeting's number), side, node, weight, grams.

    Blocks i <= j of a step meet, and each block i of a step meets each block j of the step above (across).
    """
    block = F.pmod(F.xxhash64("node"), "blocks")

    def meeting(step, across, i, j, at, side):
        return F.struct(step.alias("step"), F.lit(across).alias("across"), i.alias("i"), j.alias("j"), at.alias("at"), side.alias("side"))

    def within(o):
        i, j = F.least(o, F.col("block")), F.greatest(o, F.col("block"))
        return meeting(F.col("step"), 0, i, j, i * F.col("blocks") - (i * (i - 1) / 2).cast("long") + j - i, F.when(F.col("block") == i, 0).otherwise(1))

    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    up = lambda o: meeting(F.col("step"), 1, F.col("block"), o, F.col("block") * F.col("above") + o, F.lit(0))
    down = lambda o: meeting(F.col("step") - 1, 1, o, F.col("block"), o * F.col("blocks") + F.col("block"), F.lit(1))
    all_ = F.concat(F.transform(upto(F.col("blocks")), within), F.transform(upto(F.col("above")), up), F.transform(upto(F.col("below")), down))
    rows = sets.withColumn("block", block).select("root", "node", "weight", "grams", F.explode(all_).alias("m"))
    return rows.select("root", "m.step", "m.across", "m.i", "m.j", "m.at", "m.side", "node", "weight", "grams")


def _classed(docs: DataFrame, id_col: str, text_col: str, similar: float, recall: float, rows: int) -> DataFrame:
    """doc_id, tag, root, class_id, n_links, n_shingles of every row; root tells classes apart, null without shingles."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    bands = bands_for(similar, recall, rows)
    texts = id_and_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    schema = "key long, doc_id long, tag long, h1 long, h2 long, n long, bands array<long>"
    signed = scratch.write(map_arrow(texts, _signatures(rows, bands), schema), "signed")
    # A node for each distinct set; the row with the least key stands for it.
    by_set = signed.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("least"))
    nodes = scratch.write(by_set, "nodes")
    own = signed.select("key", "bands", "doc_id", "tag", "n").join(nodes.select(F.col("node").alias("key"), "weight"), "key")
    banded = own.select("key", F.explode("bands").alias("band"))
    leads = banded.groupBy("band").agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    near = scratch.write(banded.join(leads, "band").where("key <> b").select(F.col("key").alias("a"), "b").distinct(), "near")
    grouped = components(near, scratch, "near").join(own.select(F.col("key").alias("node"), "doc_id", "tag", "weight", "n"), "node")
    members = scratch.write(steps_of(grouped, similar), "members")
    # The sets are made anew from the texts of candidates alone: cheaper than keeping all sets.
    sides = texts.withColumn("id", F.xxhash64("doc_id")).join(members.withColumn("id", F.xxhash64("doc_id")).drop("doc_id").hint("shuffle_hash"), ["id", "tag"])
    fields = ", ".join(f"{c} long" for c in _MEMBER)
    sets = map_arrow(sides.select(*_MEMBER, "text"), _sets, f"{fields}, grams binary")
    met = meetings(sets)
    order = ["root", "step", "across", "i", "j"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartitionById(tasks, F.pmod(F.xxhash64("root", "step", "across") + F.col("at"), F.lit(tasks)).cast("int"))
    verified = scratch.write(map_arrow(dealt.sortWithinPartitions(*order).select(*order, "node", "weight", "side", "grams"), _verify(similar), "node long, links long, b long"), "verified")
    scratch.drop("near", "members")
    roots = components(verified.where("node <> b").select(F.col("node").alias("a"), "b"), scratch, "linked")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classed = nodes.join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min("least").alias("class_id"))
    of_set = scratch.write(classed.join(least, "root").select("h1", "h2", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    scratch.drop("verified", "nodes")
    out = signed.select("doc_id", "tag", "h1", "h2", "n").join(of_set, ["h1", "h2"], "left")
    some = F.col("n") > 0
    return out.select("doc_id", "tag", F.when(some, F.col("root")).alias("root"), F.when(some, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(some, F.col("n_links")).otherwise(F.lit(0)).alias("n_links"), F.col("n").alias("n_shingles"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """doc_id, tag, class_id, n_links, n_shingles: a row for each row of docs.

    tag is the hash of the text. class_id is the least doc_id of the rows linked to the row, by steps of
    similarity `similar` or more; n_links counts the other rows linked to it directly, copies included.
    """
    return _classed(docs, id_col, text_col, similar, recall, rows).drop("root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that with the class's least id (null last), of its rows one with the least text hash.

    Of rows equal in id and text any one stays. Texts without words all stay.
    """
    found = _classed(docs, id_col, text_col, SIMILAR, RECALL, ROWS)
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("lead")
    first = found.where("root is not null").groupBy("root").agg(lead).select(F.xxhash64("lead.doc_id").alias("id"), F.col("lead.tag").alias("tag"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(whole_row(docs), F.xxhash64(F.col(id_col).cast("long")).alias("id"), F.xxhash64(text).alias("tag"), text.rlike(rf"[^{SPACE[1:]}").alias("has"))
    kept = rows.where("has").join(first.hint("shuffle_hash"), ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"])
    return kept.select("row").unionByName(rows.where("not has").select("row")).select(*columns_of(docs))
