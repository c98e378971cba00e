"""Operator 8: line de-duplication that returns keep bitmaps, not text.

Long lines become 128-bit hashes; (hash, document) ranges are dealt to partitions and sorted by hash, document
and position, so a hash held by a third of all rows still spreads over many partitions. Each partition streams
its rows once: a hash that lies wholly inside is decided there; a hash that touches the partition's first or
last row, or outgrows HELD rows, is passed on with a partial count, and those few counts are added up after.

Null and empty texts are one empty line. Rows of one id count as one document; rows that are equal in id and text
lose the same lines. Ties don't arise: a line stays in the largest id that holds it, wherever it stands there.
Documents of any length are split in the worker, whose batches are bounded by bytes. An empty table gives no
bitmaps. Other columns of the table, whatever their names, are carried along untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, columns_of, let, map_arrow, whole_row

STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
#: Rows of one hash that a partition holds before it passes them on undecided.
HELD = 100_000
#: Stands for a null id: such rows are one document, below all others.
NO_ID = -(1 << 63)
DROP, PENDING, COUNT = 0, 1, 2


def row_key(id_col: str, text_col: str) -> list[Column]:
    """doc (the id), tag (64-bit hash of the text, which tells rows of one id apart) and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text")]


def _lines(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        digest = xxhash.xxh3_128_digest
        for b in batches:
            hashes, rows, pos = [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                if len(text) < min_chars:
                    continue
                for j, line in enumerate(text.split("\n")):
                    key = line.strip(STRIP)
                    if len(key) >= min_chars:
                        hashes.append(digest(key.encode().lower()))
                        rows.append(k)
                        pos.append(j)
            h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            rows = np.array(rows, np.int64)
            cols = [h[:, 0], h[:, 1], b.column("doc").to_numpy()[rows], b.column("tag").to_numpy()[rows], np.array(pos, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    return run


_FOUND = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("pos", pa.int32()), ("n", pa.int64())])


def _batch(kind: int, rows: np.ndarray, n: int = 0) -> pa.RecordBatch:
    k = len(rows)
    cols = [np.full(k, kind, np.int32), *(rows[:, i] for i in range(4)), rows[:, 4].astype(np.int32), np.full(k, n, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], schema=_FOUND)


def _decide(min_docs: int):
    """Stream sorted rows: lines to drop, lines of undecided hashes, and what this partition counted of those."""

    def docs_in(rows):
        return 1 + int((rows[1:, 2] != rows[:-1, 2]).sum()) if len(rows) else 0

    def undecided(rows, open_):
        """open_: the document counted last in an earlier part of the same group, if any."""
        n = docs_in(rows) - int(open_ is not None and len(rows) > 0 and rows[0, 2] == open_)
        yield _batch(PENDING, rows)
        yield _batch(COUNT, rows[-1:], n)

    def run(batches):
        held = np.zeros((0, 5), np.int64)  # the group at the end of what has been read
        first, passed = True, None  # whether held is the partition's first group; the last document passed on of it
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.concatenate([held, np.stack([b.column(c).to_numpy() for c in ("h1", "h2", "doc", "tag", "pos")], 1)])
            cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(1)) + 1
            if len(cut):
                if first or passed is not None:
                    yield from undecided(rows[: cut[0]], passed)
                    rows, cut = rows[cut[0] :], cut[1:] - cut[0]
                    first, passed = False, None
                last = int(cut[-1]) if len(cut) else 0
                done, rows = rows[:last], rows[last:]
                if len(done):
                    starts = np.append(0, cut[:-1])
                    new = np.append(True, (done[1:, :3] != done[:-1, :3]).any(1)).astype(np.int64)
                    size = np.diff(np.append(starts, len(done)))
                    many = np.repeat(np.add.reduceat(new, starts) >= min_docs, size)
                    top = np.repeat(done[np.append(starts[1:], len(done)) - 1, 2], size)
                    drop = done[many & (done[:, 2] != top)]
                    if len(drop):
                        yield _batch(DROP, drop)
            if len(rows) > HELD:  # the last row stays, to tell whether the next ones are of the same hash
                yield from undecided(rows[:-1], passed)
                passed, rows = int(rows[-2, 2]), rows[-1:]
            held = rows
        if len(held):
            yield from undecided(held, passed)

    return run


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc, tag, n_dropped, bitmap of each row that loses lines; rows that are not here keep them all.

    A line's key has white space stripped and A-Z lower-cased; keys of min_chars code points or more, found in
    min_docs ids or more, lose their lines in all but the largest id. The bitmap of kept lines is compressed to
    its runs: start and length of each run of dropped lines, in order; all other lines are kept.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    lines = scratch.write(map_arrow(docs.select(row_key(id_col, text_col)), _lines(min_chars), "h1 long, h2 long, doc long, tag long, pos int"), "lines")
    dealt = lines.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "tag", "pos")
    found = scratch.write(map_arrow(dealt, _decide(min_docs), "kind int, h1 long, h2 long, doc long, tag long, pos int, n long"), "found")
    scratch.drop("lines")
    # Two hashes a partition and one for each HELD rows at most. They are written down, so that Spark knows their size before it plans
    # the join: where that allows a broadcast, the undecided lines of a hot hash stay where they are.
    counts = found.where(F.col("kind") == COUNT).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc").alias("top"))
    counts = scratch.write(counts.where(F.col("docs") >= min_docs), "counts")
    late = found.where(F.col("kind") == PENDING).join(counts, ["h1", "h2"]).where("doc != top")
    drops = found.where(F.col("kind") == DROP).select("doc", "tag", "pos").unionByName(late.select("doc", "tag", "pos"))
    return drops.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("pos")).alias("gone")).select("doc", "tag", F.size("gone").cast("long").alias("n_dropped"), runs(F.col("gone")).alias("bitmap"))


def runs(at: Column) -> Column:
    """Sorted positions as runs: array<struct<start, length>>."""
    starts = F.filter(at, lambda x, i: F.coalesce(F.when(i > 0, F.get(at, i - 1)) < x - 1, F.lit(True)))
    ends = F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) > x + 1, F.lit(True)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("length")))


def kept_text(text: Column, bitmap: Column) -> Column:
    """The text's lines outside the bitmap's dropped runs; no bitmap keeps all."""

    def between(lines):
        end = lambda k: F.get(bitmap, k)["start"] + F.get(bitmap, k)["length"]

        def one(k):
            first = F.when(k > 0, end(k - 1)).otherwise(0)
            return F.slice(lines, first + 1, F.greatest(F.coalesce(F.get(bitmap, k)["start"], F.size(lines)) - first, F.lit(0)))

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(bitmap)), one)), "\n")

    return F.when(bitmap.isNull(), text).otherwise(let(F.split(text, "\n", -1), between))


def apply(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the kept lines as text_col, and __n_lines, __n_dropped besides (columns of these names are replaced).

    Null texts become empty. Only the runs are joined to the rows, and lines are taken out in the JVM.
    """
    keyed = docs.select(whole_row(docs), *row_key(id_col, text_col))
    joined = keyed.join(bitmaps.hint("shuffle_hash"), ["doc", "tag"], "left")
    text, n_lines = F.col("text"), F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    dropped = F.coalesce("n_dropped", F.lit(0).cast("long"))
    return joined.select(*columns_of(docs, **{text_col: kept_text(text, F.col("bitmap")), "__n_lines": n_lines.cast("long"), "__n_dropped": dropped}))
