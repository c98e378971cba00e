"""Operator 6: packing along a space-filling curve.

Each document's tokens are projected by signed hashing to DIMS numbers, quantised and turned into a Hilbert key.
Rows are range-sorted by that key, then by a hash of the document, so that equal keys still spread over partitions,
and laid out end to end along the curve; the running position of a row, its partition's start plus its place
there, gives the sequences it falls into. Ranges hold about equally many tokens, not rows: their borders are
quantiles of a sketch in which a row counts once for each GRAIN tokens, as long documents lie together at the
curve's ends. Only the very last sequence is not full, and it is split at powers of two, which need no padding. The
driver sees borders and totals of partitions, a number each.

Null and empty texts are the end token alone. Texts of any length are encoded whole and cut wherever a sequence
ends; a document is in one range, however long. Ties on the curve go by the hash, then by id, null ids first; repeated rows are packed each
for itself. An empty table has no pieces. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, map_arrow
from .tokens import byte_bpe, vocabulary

VOCABULARY = "byte_bpe_50k.json"
LENGTH, END, DIMS, BITS = 2048, 1, 4, 12
#: Bytes of ids in a partition: at most about PART whatever the session's setting, and no less than SMALL where that asks for more partitions.
PART, SMALL = 64 << 20, 1 << 20
#: Tokens for which a row counts once in the sketch that borders are taken from, its accuracy for each partition, and steps to a partition.
GRAIN, ACCURACY, STEPS = 256, 200, 8


def projection(n: int, dims: int = DIMS) -> np.ndarray:
    """The sign with which each token id counts in each dimension, by a fixed integer hash."""
    x = np.arange(n, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(16))) * np.uint64(0x45D9F3B3335B369)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([np.where((x >> np.uint64(40 + d)) & np.uint64(1), 1.0, -1.0) for d in range(dims)], 1).astype(np.float32)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of points with integer coordinates below 2**bits, one a row."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    m = 1 << (bits - 1)
    q = m
    while q > 1:  # undo excess work, from the largest bit down
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            t = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = m
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys from each document's summed signs: scaled to standard deviations, then squeezed to BITS bits."""
    z = sums / np.sqrt(np.maximum(sizes, 1))[:, None]
    return hilbert(np.clip((np.arctan(z / 4) / np.pi + 0.5) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64))


def encode(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """doc_id, key, n, ids (16-bit little-endian, END last) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        bpe, signs = byte_bpe(path), projection(1 << 16)
        for b in batches:
            ids = [np.array([*bpe.encode(t), END], np.uint16) for t in b.column("text").to_pylist()]
            if not ids:
                continue
            sizes = np.array([len(x) for x in ids])
            sums = np.stack([signs[x].sum(0) for x in ids])
            arrays = [b.column("doc_id"), pa.array(curve_keys(sums, sizes)), pa.array(sizes), pa.array([x.tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, key long, n long, ids binary")


def borders(rows: DataFrame, partitions: int) -> list[int]:
    """Keys along the curve that part rows (key, n) into steps of about equally many tokens, STEPS a partition; a key that fills several steps is there several times."""
    if partitions < 2:
        return []
    counted = rows.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / GRAIN))))
    shares = F.array(*[F.lit(k / (STEPS * partitions)) for k in range(1, STEPS * partitions)])
    return sorted(counted.agg(F.percentile_approx("key", shares, max(10_000, ACCURACY * partitions)).alias("at")).first().at or [])


def ranges_of(keys: np.ndarray, hashes: np.ndarray, at: list[int]) -> np.ndarray:
    """The partition of each key; of a key at borders the rows are dealt to the steps that meet there by their 24-bit hashes, in order."""
    edges = np.array(at, np.int64)
    low, high = np.searchsorted(edges, keys, "left"), np.searchsorted(edges, keys, "right")
    return ((low + (hashes * (high - low + 1) >> 24)) // STEPS).astype(np.int32)


def _dealt(rows: DataFrame, at: list[int]) -> DataFrame:
    """rows with the number of their range."""

    def run(batches):
        for b in batches:
            part = ranges_of(b.column("key").to_numpy(), b.column("h").to_numpy(), at)
            yield pa.RecordBatch.from_arrays([pa.array(part), *b.columns], names=["part", *b.schema.names])

    return map_arrow(rows, run, "part int, key long, h long, doc_id long, n long, ids binary")


def _numbered(rows: DataFrame) -> DataFrame:
    """part and the tokens before each row in its partition, in the partition's order."""
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n").to_numpy()
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            arrays = [pa.array(np.full(len(n), part, np.int32)), pa.array(before), b.column("doc_id"), b.column("n"), b.column("ids")]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_arrow(rows, run, "part int, before long, doc_id long, n long, ids binary")


def pieces_of(at: int, n: int, full: int, length: int, tail: list[tuple[int, int]]):
    """(start, length, sequence, offset) of the pieces of a document at place `at` along the curve."""
    out, start = [], 0
    while start < n:
        g = at + start
        if g < full:
            seq, first, end = g // length, g // length * length, (g // length + 1) * length
        else:
            k = next(k for k, (a, b) in enumerate(tail) if a <= g < b)
            seq, (first, end) = full // length + k, tail[k]
        size = min(n - start, end - g)
        out.append((start, size, seq, g - first))
        start += size
    return out


def tail_blocks(total: int, length: int) -> tuple[int, list[tuple[int, int]]]:
    """Where the full sequences end, and the blocks of powers of two that hold the rest."""
    full = at = total // length * length
    blocks = []
    for bit in reversed(range(length.bit_length())):
        if (total - full) >> bit & 1:
            blocks.append((at, at + (1 << bit)))
            at += 1 << bit
    return full, blocks


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, partitions: int | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    path = path or vocabulary(VOCABULARY)
    scratch = Scratch(spark, "packing")
    encoded = scratch.write(encode(docs, id_col, text_col, path), "encoded")
    encoded = encoded.select("key", F.shiftrightunsigned(F.xxhash64("doc_id"), 40).alias("h"), "doc_id", "n", "ids")
    if not partitions:
        size = 2 * (encoded.agg(F.sum("n")).first()[0] or 0)
        partitions = max(1, math.ceil(size / PART), min(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SMALL))
    at = borders(encoded, partitions)
    dealt = _dealt(encoded, at).repartitionById(partitions, F.col("part")).sortWithinPartitions("key", "h", "doc_id")
    laid = scratch.write(_numbered(dealt.select("doc_id", "n", "ids")), "laid")
    scratch.drop("encoded")
    totals = dict(laid.groupBy("part").agg(F.sum("n")).collect())
    starts, total = {}, 0
    for part in sorted(totals):
        starts[part] = total
        total += totals[part]
    full, tail = tail_blocks(total, length)
    whole = pa.int64()
    schema = pa.schema([("doc_id", whole), ("start", whole), ("length", whole), ("ids", pa.binary()), ("ids_crc32", whole), ("doc_tokens", whole), ("sequence_id", whole), ("offset", whole)])

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            for part, before, doc, n, data in zip(*(b.column(c).to_pylist() for c in ("part", "before", "doc_id", "n", "ids"))):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                for start, size, seq, offset in pieces_of(starts[part] + before, n, full, length, tail):
                    piece = ids[start : start + size].tobytes()
                    for c, v in zip(cols, (doc, start, size, piece, zlib.crc32(piece), n, seq, offset)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return map_arrow(laid, run, "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
