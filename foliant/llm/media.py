"""Operator 5: ISO media containers as columns.

``walk`` reads nested boxes of any depth; ``index`` decodes the sample tables of each track (stts, ctts, stsc,
stsz or stz2, stco or co64, stss), its edit list and its fragments (moof, traf, trun), and gives codec, duration
and the byte ranges of its keyframes. Payload bytes are never decoded: only ranges of the file are named.
``store`` writes bytes as 8-bit samples in such a container.

Damaged containers give empty or shortened tables, never an error: a count is believed only as far as the box,
or the file, has bytes for it. Null and empty containers have no tracks; null texts are stored as empty ones. Equal texts
have equal rows but for the id; repeated rows repeat. An empty table gives no rows. Texts of any length are stored
whole. Other columns go no further.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_arrow

#: Bytes of one stored sample (of 8-bit units), samples of a chunk, samples from one keyframe to the next.
SAMPLE, CHUNK, GROUP, RATE = 192, 64, 16, 8000
NESTED = frozenset([b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf", b"meta"])


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 65536, 0, 0, 0, 65536, 0, 0, 0, 1 << 30)
_FTYP = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isommp41")
_HDLR = full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"bytes\0")
_DINF = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
_STSD = full(b"stsd", struct.pack(">I", 1), box(b"raw ", struct.pack(">6xH8xHHHHI", 1, 1, 8, 0, 0, RATE << 16)))


def store(payload: bytes) -> bytes:
    """The payload, a multiple of SAMPLE bytes, as one track of 8-bit samples."""
    n = len(payload) // SAMPLE
    chunks, ticks = -(-n // CHUNK), n * SAMPLE
    runs = [(1, CHUNK)] * (n >= CHUNK) + [(n // CHUNK + 1, n % CHUNK)] * (n % CHUNK > 0)
    stsc = struct.pack(">I", len(runs)) + b"".join([struct.pack(">III", first, k, 1) for first, k in runs])
    keys = np.arange(1, n + 1, GROUP, dtype=">u4")
    tables = (
        _STSD,
        full(b"stts", struct.pack(">III", 1, n, SAMPLE)),
        full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
        full(b"stsc", stsc),
        full(b"stsz", struct.pack(">II", SAMPLE, n)),
    )
    head = len(_FTYP) + 8
    size = chunks * CHUNK * SAMPLE

    def moov(offsets: bytes) -> bytes:
        stbl = box(b"stbl", *tables, full(b"stco", struct.pack(">I", chunks), offsets))
        minf = box(b"minf", full(b"smhd", struct.pack(">I", 0)), _DINF, stbl)
        mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, ticks, 0x55C4, 0)), _HDLR, minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, ticks, 0, 0, 256, 0), _MATRIX, bytes(8), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, RATE, ticks, 65536, 256), _MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    # The samples come first, so the offsets don't depend on the header's length.
    offsets = np.arange(head, head + size, CHUNK * SAMPLE, dtype=">u4").tobytes()
    return b"".join([_FTYP, struct.pack(">I4s", 8 + len(payload), b"mdat"), payload, moov(offsets)])


def walk(data: bytes, at: int = 0, end: int | None = None):
    """(kind, path, start, end, head) of the body of every box, outer before inner, and where its header begins; stops at a box that doesn't fit."""
    stack = [(at, len(data) if end is None else end, ())]
    while stack:
        at, end, path = stack.pop()
        while at + 8 <= end:
            size, kind = struct.unpack_from(">I4s", data, at)
            body = at + 8
            if size == 1 and at + 16 <= end:
                size, body = struct.unpack_from(">Q", data, body)[0], at + 16
            elif size == 0:
                size = end - at
            if size < body - at or at + size > end:
                break
            yield kind, path, body, at + size, at
            if kind in NESTED:
                stack.append((at + size, end, path))
                # A meta box has a version and flags before its boxes, but in old files it has none.
                skip = 4 if kind == b"meta" and data[body + 4 : body + 8] != b"hdlr" else 0
                at, end, path = body + skip, at + size, (*path, kind)
                continue
            at += size


def _table(data: bytes, at: int, end: int, width: int, kind: str = ">u4") -> np.ndarray:
    """Rows of width numbers after a count at `at`, as many as the count says and the box holds."""
    size = np.dtype(kind).itemsize * width
    n = min(struct.unpack_from(">I", data, at)[0], (end - at - 4) // size) if end - at >= 4 else 0
    return np.frombuffer(data, kind, n * width, at + 4).reshape(n, width).astype(np.int64)


def _runs(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Values repeated as often as counts say, `most` in all at most."""
    upto = np.minimum(np.cumsum(np.minimum(counts, most)), most)
    return np.repeat(values, np.diff(np.append(0, upto)))


def _sizes(data: bytes, kind: bytes, at: int, end: int) -> np.ndarray:
    if kind == b"stsz":
        size, n = struct.unpack_from(">II", data, at + 4)
        if size:  # one size for all: there can't be more samples than the file has room for
            return np.full(min(n, len(data) // size), size, np.int64)
        return _table(data, at + 8, end, 1)[:, 0]
    bits, n = data[at + 7], struct.unpack_from(">I", data, at + 8)[0]
    if bits == 4:
        raw = np.frombuffer(data, np.uint8, min((n + 1) // 2, end - at - 12), at + 12)
        return np.stack([raw >> 4, raw & 15], 1).reshape(-1)[:n].astype(np.int64)
    return _table(data, at + 8, end, 1, ">u2" if bits == 16 else ">u1")[:, 0] if bits in (8, 16) else np.zeros(0, np.int64)


def _located(t: dict) -> None:
    """offset, size, time, shown (composition time) and sync of a track's samples from its tables."""
    none = np.zeros(0, np.int64)
    sizes, chunks, stsc, stts, ctts, stss = (t.pop(k, none) for k in ("sizes", "chunks", "stsc", "stts", "ctts", "stss"))
    if not len(stsc):
        stsc = np.array([[1, 0, 1]])
    first = np.clip(stsc[:, 0] - 1, 0, len(chunks))
    per = np.repeat(stsc[:, 1], np.diff(np.append(first, len(chunks))).clip(0))[: len(chunks)]
    owner = _runs(np.arange(len(per)), per, len(sizes))
    sizes = sizes[: len(owner)]
    before = np.cumsum(sizes) - sizes
    start = np.searchsorted(owner, owner)
    n = len(sizes)
    t["offset"], t["size"] = chunks[owner] + before - before[start] if n else before, sizes
    ticks = _runs(stts[:, 1], stts[:, 0], n) if len(stts) else none
    ticks = np.append(ticks, np.zeros(n - len(ticks), np.int64))
    shift = _runs(ctts[:, 1].astype(np.int32).astype(np.int64), ctts[:, 0], n) if len(ctts) else none
    t["time"] = np.cumsum(ticks) - ticks
    t["shown"] = t["time"] + np.append(shift, np.zeros(n - len(shift), np.int64)) - t.pop("skipped", 0)
    t["sync"] = np.unique(stss[(stss >= 0) & (stss < n)]) if t.pop("keyed", False) else np.arange(n)


def _run(data: bytes, at: int, end: int, f: dict) -> None:
    """The samples of one run of a track's fragment, added to the track."""
    flags, n = struct.unpack_from(">II", data, at)[0] & 0xFFFFFF, struct.unpack_from(">I", data, at + 4)[0]
    p = at + 8
    opening = [flags >> k & 1 for k in (0, 2)]
    if end - p < 4 * sum(opening):
        return
    if opening[0]:
        f["at"] = f["base"] + struct.unpack_from(">i", data, p)[0]
        p += 4
    first = struct.unpack_from(">I", data, p)[0] if opening[1] else None
    p += 4 * opening[1]
    fields = [k for k in (8, 9, 10, 11) if flags >> k & 1]
    n = min(n, (end - p) // (4 * len(fields)) if fields else len(data) // f["size"] if f["size"] else 0)
    rows = np.frombuffer(data, ">u4", n * len(fields), p).reshape(n, len(fields)).astype(np.int64)
    column = lambda k, other: rows[:, fields.index(k)] if k in fields else np.full(n, other, np.int64)
    ticks, sizes, marks = column(8, f["ticks"]), column(9, f["size"]), column(10, f["flags"]).copy()
    if first is not None and n and 10 not in fields:
        marks[0] = first
    t = f["track"]
    time = f["time"] + np.cumsum(ticks) - ticks
    t["sync"] = np.append(t["sync"], len(t["size"]) + np.flatnonzero((marks & 0x10000) == 0))
    for name, values in (("offset", f["at"] + np.cumsum(sizes) - sizes), ("size", sizes), ("time", time), ("shown", time + column(11, 0).astype(np.int32))):
        t[name] = np.append(t[name], values)
    f["at"] += int(sizes.sum())
    f["time"] += int(ticks.sum())


def index(data: bytes) -> list[dict]:
    """A dict of each track: codec, timescale, duration, samples (offset, size, time, shown), sync (sample numbers from 0).

    What is missing or doesn't fit is left empty; a track without stss has every sample as a keyframe. Samples
    that lie outside the file are left out. shown is time with composition offsets, from the edit list's start.
    """
    tracks: list[dict] = []
    defaults: dict[int, tuple] = {}
    f: dict | None = None
    moof = 0
    for kind, path, at, end, head in walk(data):
        size = end - at
        if kind == b"trak":
            tracks.append({"codec": "", "timescale": 0, "duration": 0, "id": 0})
        elif kind == b"moof":
            for t in tracks:
                if "offset" not in t:
                    _located(t)
            moof, f = head, None
        elif kind == b"trex" and size >= 24:
            one, _, *rest = struct.unpack_from(">IIIII", data, at + 4)
            defaults[one] = tuple(rest)
        elif kind == b"tfhd" and path[:1] == (b"moof",) and size >= 8:
            flags, one = struct.unpack_from(">II", data, at)
            track = next((t for t in tracks if t["id"] == one), None)
            values, p = {"base": moof}, at + 8
            for bit, name, code in ((0, "base", ">Q"), (1, "", ">I"), (3, "ticks", ">I"), (4, "size", ">I"), (5, "flags", ">I")):
                if flags >> bit & 1 and p + struct.calcsize(code) <= end:
                    values[name] = struct.unpack_from(code, data, p)[0]
                    p += struct.calcsize(code)
            ticks, each, marks = defaults.get(one, (0, 0, 0))
            f = None if track is None else {"ticks": ticks, "size": each, "flags": marks, "track": track, "time": int(track["time"][-1:].sum())} | values
            if f:
                f["at"] = f["base"]
        elif kind == b"tfdt" and f and size >= 8 + 4 * (data[at] == 1):
            f["time"] = struct.unpack_from(">Q" if data[at] == 1 else ">I", data, at + 4)[0] & (1 << 62) - 1
        elif kind == b"trun" and f and size >= 8:
            _run(data, at, end, f)
        if not tracks or size < 8 or "offset" in tracks[-1]:
            continue
        t = tracks[-1]
        if kind == b"tkhd" and size >= 24:
            t["id"] = struct.unpack_from(">I", data, at + (20 if data[at] == 1 else 12))[0]
        elif kind == b"mdhd" and size >= (32 if data[at] == 1 else 20):
            t["timescale"], t["duration"] = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
            t["duration"] &= (1 << 63) - 1
        elif kind == b"stsd" and size >= 16:
            t["codec"] = data[at + 12 : at + 16].decode("latin-1").strip()
        elif kind in (b"stsz", b"stz2") and size >= 12:
            t["sizes"] = _sizes(data, kind, at, end)
        elif kind in (b"stts", b"ctts"):
            t[kind.decode()] = _table(data, at + 4, end, 2)
        elif kind == b"stsc":
            t["stsc"] = _table(data, at + 4, end, 3)
        elif kind == b"stss":
            t["stss"], t["keyed"] = _table(data, at + 4, end, 1)[:, 0] - 1, True
        elif kind in (b"stco", b"co64"):
            t["chunks"] = _table(data, at + 4, end, 1, ">u4" if kind == b"stco" else ">u8")[:, 0]
        elif kind == b"elst":
            rows = np.frombuffer(data, np.dtype([("d", ">u8"), ("t", ">i8"), ("r", ">u4")] if data[at] == 1 else [("d", ">u4"), ("t", ">i4"), ("r", ">u4")]), min(struct.unpack_from(">I", data, at + 4)[0], (size - 8) // (20 if data[at] == 1 else 12)), at + 8)
            t["skipped"] = next((int(x) for x in rows["t"] if x >= 0), 0)
    for t in tracks:
        if "offset" not in t:
            _located(t)
        inside = (t["offset"] >= 0) & (t["size"] >= 0) & (t["offset"] <= len(data) - t["size"])
        if not inside.all():
            place = np.cumsum(inside) - 1
            t["sync"] = place[t["sync"][inside[t["sync"]]]]
            for name in ("offset", "size", "time", "shown"):
                t[name] = t[name][inside]
    return tracks


def read_back(data: bytes, track: dict) -> bytes:
    """The track's bytes by its sample ranges; neighbouring ranges are read together."""
    offset, size = track["offset"], track["size"]
    if not len(offset):
        return b""
    cut = np.flatnonzero(offset[1:] != offset[:-1] + size[:-1]) + 1
    starts, ends = offset[np.append(0, cut)], (offset + size)[np.append(cut - 1, len(offset) - 1)]
    return b"".join([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


def feature(track: dict) -> str:
    """codec/timescale/duration/samples/keyframes/CRC of the keyframes' (offset, size) ranges."""
    at = track["sync"]
    ranges = np.stack([track["offset"][at], track["size"][at]], 1).astype("<i8").tobytes()
    return f"{track['codec']}/{track['timescale']}/{track['duration']}/{len(track['size'])}/{len(at)}/{zlib.crc32(ranges):08x}"


_KEYFRAME = pa.struct([("offset", pa.int64()), ("size", pa.int64()), ("time", pa.int64())])
KEYFRAMES = "array<struct<offset:long,size:long,time:long>>"


def keyframes(tracks: list[dict]) -> pa.Array:
    """Byte ranges and times of the keyframes of each track, as one list column."""
    ends = np.cumsum([0, *(len(t["sync"]) for t in tracks)]).astype(np.int32)
    column = lambda name: pa.array(np.concatenate([np.zeros(0, np.int64), *(t[name][t["sync"]] for t in tracks)]))
    values = pa.StructArray.from_arrays([column("offset"), column("size"), column("shown")], fields=list(_KEYFRAME))
    return pa.ListArray.from_arrays(pa.array(ends), values)


def media_columns(media: DataFrame, id_col: str = "doc_id", data_col: str = "media") -> DataFrame:
    """A row for each track of each container: id, track, codec, timescale, duration, keyframes (offset, size, time)."""
    schema = f"id long, track int, codec string, timescale long, duration long, keyframes {KEYFRAMES}"
    whole = pa.int64()
    out = pa.schema([("id", whole), ("track", pa.int32()), ("codec", pa.string()), ("timescale", whole), ("duration", whole), ("keyframes", pa.list_(_KEYFRAME))])

    def run(batches):
        for b in batches:
            rows = [(i, k, t) for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, t in enumerate(index(data or b""))]
            values = [[i for i, _, _ in rows], [k for _, k, _ in rows], *([t[c] for _, _, t in rows] for c in ("codec", "timescale", "duration"))]
            arrays = [pa.array(v, f.type) for v, f in zip(values, out)]
            yield pa.RecordBatch.from_arrays([*arrays, keyframes([t for _, _, t in rows]).cast(out.field("keyframes").type)], schema=out)

    return map_arrow(media.select(F.col(id_col).cast("long").alias("id"), F.col(data_col).alias("media")), run, schema)


def payload_of(text: str) -> tuple[int, bytes]:
    """UTF-8 bytes of a text and how many, with spaces up to a positive multiple of SAMPLE."""
    raw = text.encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // SAMPLE)) * SAMPLE)


def stored_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a container, read it back by its tables and describe both; with the keyframes' byte ranges."""
    schema = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, keyframes {KEYFRAMES}"
    whole, word = pa.int64(), pa.string()
    out = pa.schema([("doc_id", whole), ("n_bytes", whole), ("payload_bytes", whole), ("payload_sha256", word), ("tail_crc32", whole), ("media_bytes", whole), ("media_sha256", word), ("feature", word), ("keyframes", pa.list_(_KEYFRAME))])

    def run(batches):
        sha = hashlib.sha256
        for b in batches:
            rows, tracks = [], []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                n, payload = payload_of(text)
                media = store(payload)
                track = index(media)[0]
                back = read_back(media, track)
                rows.append((i, n, len(back), sha(back).hexdigest(), zlib.crc32(back[-16:]), len(media), sha(media).hexdigest(), feature(track)))
                tracks.append(track)
            arrays = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(list(out)[:-1])]
            yield pa.RecordBatch.from_arrays([*arrays, keyframes(tracks).cast(out.field("keyframes").type)], schema=out)

    return map_arrow(id_and_text(docs, id_col, text_col), run, schema)
