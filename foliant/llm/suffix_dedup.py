"""Operator 11: exact duplicates of LENGTH bytes, by external induced sorting of suffixes within shards.

Equal windows of LENGTH bytes must meet in one shard. Every window names as its anchor the least hash among the runs of
K bytes in it, so equal windows have equal anchors, and windows side by side mostly share one: they form a segment.
Segments with an anchor that occurs once hold no repeat. Segments of an anchor whose bytes are all the same repeat whole. Only
where an anchor has different segments are their bytes fetched, one copy of each, dealt to shards by anchor, and their
suffixes sorted (suffixes.py): a window is repeated if its suffix shares LENGTH bytes with a neighbour in that order.

An anchor with more than MANY different segments, such as that of a passage in every other document, would outgrow a
shard. Its segments are split again by anchors of longer runs, of which fewer windows share one; with K = LENGTH every
window has an anchor of its own, so this ends, and no window is left out on the way.

Null and empty texts have no bytes; texts shorter than LENGTH lose none. Repeated rows repeat each other. Null ids are
kept apart by their texts. Ties don't arise: all places of a repeat are removed. Texts of any length are read whole, in batches
bounded by bytes, an empty table gives no rows. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow
from .suffixes import room, sorted_suffixes

LENGTH = 400
#: Bytes of an anchor's run, as shares of LENGTH, from one split to the next.
RUNS = (0.4, 0.7, 0.88, 0.96, 0.99, 1.0)
#: Different segments of an anchor that go to one shard together, and about how many bytes a shard holds.
MANY, SHARD = 2000, 8 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def run_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k bytes, put together from runs of powers of two."""
    x = (data.astype(np.uint64) + np.uint64(1)) * _A
    x ^= x >> np.uint64(32)
    out, done, size, n = None, 0, 1, len(data) - k + 1
    while True:
        if k & size:
            part = x[done : done + n]
            out = part * _B if out is None else (out ^ part) * _A
            out ^= out >> np.uint64(31)
            done += size
        if size * 2 > k:
            break
        x = (x[:-size] * _B) ^ (x[size:] >> np.uint64(29)) ^ (x[size:] * _A)
        size *= 2
    out *= _B
    out ^= out >> np.uint64(32)
    return out


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    n = len(x) - width + 1
    blocks = np.append(x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, 1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def segments(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, windows and anchor hash of each segment of a text."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = run_hashes(np.frombuffer(data, np.uint8), k)
    low = np.uint64(0xFFFFFFFF)
    at = (_window_least((h & ~low) | np.arange(len(h), dtype=np.uint64), length - k + 1) & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return first, np.diff(np.append(first, len(at))), h[at[first]].view(np.int64)


_SEGMENT = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int32()), ("windows", pa.int32()), ("h", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])


def _cut(length: int, k: int):
    def run(batches):
        for b in batches:
            rows, parts, digests = [], [], []
            for row, text in enumerate(b.column("text").to_pylist()):
                lo, windows, h = segments(text, length, k)
                if len(lo):
                    parts.append(np.stack([lo, windows, h]))
                    rows += [row] * len(lo)
                    digests += [xxhash.xxh3_128_digest(text[x : x + w + length - 1]) for x, w in zip(lo.tolist(), windows.tolist())]
            if rows:
                lo, windows, h = np.concatenate(parts, 1)
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                cols = [b.column("id").take(at), b.column("tag").take(at), lo.astype(np.int32), windows.astype(np.int32), h, d[:, 0], d[:, 1]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c)) for c in cols], schema=_SEGMENT)

    return run


def _fetch(length: int):
    """The bytes of the segments asked of a text."""
    schema = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int32()), ("h", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("one", pa.bool_()), ("text", pa.binary())])

    def run(batches):
        for b in batches:
            asked = b.column("asked")
            flat = asked.flatten()
            of = pa.array(np.repeat(np.arange(b.num_rows), np.diff(asked.offsets.to_numpy())))
            texts = b.column("text").to_pylist()
            lo, windows = flat.field("lo"), flat.field("windows")
            cut = [texts[r][x : x + w + length - 1] for r, x, w in zip(of.to_pylist(), lo.to_pylist(), windows.to_pylist())]
            for low in range(0, len(cut), 4096):
                part = slice(low, low + 4096)
                cols = [b.column("id").take(of[part]), b.column("tag").take(of[part]), lo[part], *(flat.field(c)[part] for c in ("h", "d1", "d2", "one")), pa.array(cut[part], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


_RUN = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def _sort_shard(length: int):
    """Sort the suffixes of the task's segments; the runs of repeated windows of segments that occur once."""

    def run(batches):
        where, kept = [], []
        for b in batches:
            if b.num_rows:
                where.append([b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag", "lo", "one")])
                data = b.column("text")
                ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
                raw = room(int(ends[-1] - ends[0]), np.uint8)
                raw[:] = np.frombuffer(data.buffers()[2], np.uint8)[ends[0] : ends[-1]]
                kept.append((raw, np.diff(ends)))
        if not kept:
            return
        sizes = np.concatenate([s for _, s in kept]).astype(np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        text = room(int(sizes.sum()) + len(sizes) + 1, np.uint16)  # bytes from 2 on, 1 after each segment, 0 at the end
        at = 0
        for raw, own in kept:
            n = len(raw) + len(own)
            text[at : at + n] = np.insert(raw.astype(np.uint16) + 2, np.cumsum(own), 1)
            at += n
        del kept, raw
        order, shared = sorted_suffixes(text)
        del text
        long = shared >= length
        long[:-1] |= long[1:]
        found = np.sort(order[long])
        del order, shared, long
        segment = np.searchsorted(starts, found, "right") - 1
        inside = found - starts[segment]
        one = np.concatenate([w[3] for w in where]).astype(bool)
        good = (inside + length <= sizes[segment]) & one[segment]
        segment, inside = segment[good], inside[good]
        if not len(segment):
            return
        opens = np.append(True, (segment[1:] != segment[:-1]) | (inside[1:] != inside[:-1] + 1))
        closes = np.append(opens[1:], True)
        of = segment[opens]
        id_, tag, lo = (np.concatenate([w[k] for w in where])[of] for k in range(3))
        cols = [id_, tag, (lo + inside[opens]).astype(np.int32), (lo + inside[closes] + 1).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=_RUN)

    return run


def repeated(texts: DataFrame, scratch: Scratch, length: int = LENGTH, many: int = MANY, shard: int = SHARD, level: int = 0) -> DataFrame:
    """id, tag, start, stop: the runs of repeated windows (stop exclusive) of texts (id, tag, text binary).

    Runs may touch; each window is in one of them. Texts equal in id and tag are taken for equal.
    """
    name = lambda x: f"{x}-{level}"
    k = max(1, round(RUNS[level] * length))
    cut = scratch.write(map_arrow(texts, _cut(length, k), "id long, tag long, lo int, windows int, h long, d1 long, d2 long"), name("cut"))
    least = [f(c).alias(f"{n}_{c}") for c in ("d1", "d2") for n, f in (("least", F.min), ("most", F.max))]
    shared = cut.groupBy("h").agg(F.count(F.lit(1)).alias("n"), *least).where("n > 1")
    shared = scratch.write(shared.select("h", F.expr("least_d1 < most_d1 OR least_d2 < most_d2").alias("mixed")), name("shared"))
    twice = scratch.write(cut.join(shared, "h"), name("twice"))
    scratch.drop(name("cut"), name("shared"))
    place = lambda lo: (F.col(lo).cast("int").alias("start"), (F.col(lo) + F.col("windows")).cast("int").alias("stop"))
    whole = twice.where("not mixed").select("id", "tag", *place("lo"))

    # A row for each distinct segment of an anchor that has several; those found more than once repeat whole.
    kinds = twice.where("mixed").groupBy("h", "d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "tag", "lo", "windows")).alias("at"))
    kinds = scratch.write(kinds.select("h", "d1", "d2", (F.col("n") == 1).alias("one"), "at.*"), name("kinds"))
    copies = twice.where("mixed").join(kinds.where("not one").select("h", "d1", "d2"), ["h", "d1", "d2"]).select("id", "tag", *place("lo"))
    counts = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + length).alias("bytes"), F.max("one").alias("open"))
    counts = scratch.write(counts.where("open").select("h", "bytes", (F.col("kinds") > many).alias("hot") if level + 1 < len(RUNS) else F.lit(False).alias("hot")), name("counts"))
    asked = kinds.join(counts, "h").groupBy("id", "tag").agg(F.collect_list(F.struct("lo", "windows", "h", "d1", "d2", "one")).alias("asked"))
    fields = "id long, tag long, lo int, h long, d1 long, d2 long, one boolean, text binary"
    held = texts.join(scratch.write(asked, name("asked")).hint("shuffle_hash"), ["id", "tag"])
    size = counts.groupBy("hot").agg(F.sum("bytes").alias("bytes")).collect()  # two rows at most
    size = {r.hot: r.bytes for r in size}
    fetched = map_arrow(held, _fetch(length), fields)
    if True in size:
        fetched = scratch.write(fetched.join(counts, "h").drop("bytes"), name("fetched"))
        cold = fetched.where("not hot")
    else:
        cold = fetched
    tasks = max(1, -(-size.get(False, 0) // shard))
    found = map_arrow(cold.repartition(tasks, "h").select("id", "tag", "lo", "one", "text"), _sort_shard(length), "id long, tag long, start int, stop int")
    out = scratch.write(whole.unionByName(copies).unionByName(found), name("found"))
    if True in size:
        hot = fetched.where("hot")
        deeper = repeated(hot.select(F.col("d1").alias("id"), F.col("d2").alias("tag"), "text"), scratch, length, many, shard, level + 1)
        own = hot.where("one").select("id", "tag", "lo", "d1", "d2")
        inner = deeper.select(F.col("id").alias("d1"), F.col("tag").alias("d2"), "start", "stop")
        out = out.unionByName(scratch.write(own.join(inner, ["d1", "d2"]).select("id", "tag", (F.col("lo") + F.col("start")).alias("start"), (F.col("lo") + F.col("stop")).alias("stop")), name("inner")))
    scratch.drop(name("twice"), name("kinds"), name("counts"), name("asked"))
    return out


def _remove(length: int):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    def run(batches):
        for b in batches:
            spans, kept = [], []
            texts = b.column("text").to_pylist()
            runs = b.column("runs").to_pylist()
            for text, found in zip(texts, runs):
                own, parts, last = [], [], 0
                for start, stop in sorted((x["start"], x["stop"] + length - 1) for x in found or ()):
                    if own and start <= own[-1]["end"]:
                        own[-1]["end"] = max(stop, own[-1]["end"])
                    else:
                        own.append({"start": start, "end": stop})
                for x in own:
                    parts.append(text[last : x["start"]])
                    last = x["end"]
                spans.append(own)
                kept.append(b"".join([*parts, text[last:]]) if own else text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(spans, schema.field("spans").type), pa.array(kept, pa.binary())], schema=schema)

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", many: int = MANY, shard: int = SHARD) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed byte ranges, end exclusive) and kept (binary) of every row of docs."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long")).alias("id"), F.xxhash64(text).alias("tag"), text.cast("binary").alias("text"))
    found = repeated(keyed.select("id", "tag", "text"), scratch, length, many, shard)
    runs = found.distinct().groupBy("id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    joined = keyed.join(scratch.write(runs, "runs").hint("shuffle_hash"), ["id", "tag"], "left")
    return map_arrow(joined.select("doc_id", "text", "runs"), _remove(length), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
