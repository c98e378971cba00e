"""Sorted suffixes with common-prefix values by induced sorting, in arrays that go to disk when they grow large.

The text's S*-suffixes (those that begin where it stops falling) are sorted first: their substrings up to the next one
are named by rank, the names, two digits each, are a shorter text, and its suffixes are sorted by recursion. From them all
L-suffixes follow in one ascending scan, from those all S-suffixes in one descending scan. Each scan takes the tuples
(suffix, common-prefix value) of a priority queue in order and puts the tuples of the suffixes one symbol longer into
it; their value is one more than the least value passed since the last tuple put under the same first symbol.

Keys enter the queue in ascending order, and how many tuples have which first symbol is known, so the queue is one array
with a region for each first symbol, filled and read from front to back. Arrays beyond SPILL bytes are mapped from unnamed
files of the task, which are gone with it however it ends; scans touch CHUNK tuples at a time.
"""

from __future__ import annotations

import tempfile

import numpy as np

SPILL = 64 << 20
CHUNK = 1 << 20
#: Names that are symbols of their own in the shorter text, and the length up to which (or where it isn't shorter) runs are doubled instead.
FEW, SMALL = 1024, 1 << 20
_FAR = np.int32(2**31 - 2)


def room(n: int, dtype) -> np.ndarray:
    """An array, in a file without a name where it is large."""
    if n * np.dtype(dtype).itemsize <= SPILL:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as f:
        f.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(f, dtype, "r+", shape=(n,))


def _kept(x: np.ndarray) -> np.ndarray:
    """x in a room of its own."""
    out = room(len(x), x.dtype)
    out[:] = x
    return out


def _rising(t: np.ndarray) -> np.ndarray:
    """True for S-suffixes: the next different symbol is larger. The last symbol, the least of all, counts as one."""
    out = room(len(t), bool)
    out[-1] = True
    after = False  # of the first position after the block; equal symbols have the type of the next position
    for high in range(len(t) - 1, 0, -CHUNK):
        low = max(0, high - CHUNK)
        a, b = t[low:high], t[low + 1 : high + 1]
        at = np.where(a != b, np.arange(high - low), high - low)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        out[low:high] = np.append(a < b, after)[nxt]
        after = out[low]
    return out


def _least(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of value[low..high] of each pair, by minima over powers of two."""
    out = np.empty(len(low), value.dtype)
    if not len(low):
        return out
    level = np.frexp(high - low + 1)[1] - 1
    table, size = value, 1
    for k in range(int(level.max()) + 1):
        if k:
            table = np.minimum(table[:-size], table[size:])
            size *= 2
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - size + 1])
    return out


def _longer(t: np.ndarray, p: np.ndarray, q: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Symbols that suffixes p and q share, given that they share so many at least."""
    live = np.arange(len(p))
    while len(live):
        live = live[t[p[live] + shared[live]] == t[q[live] + shared[live]]]
        shared[live] += 1
    return shared


def _names(t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rank of each S*-substring, from its position up to the next one's; equal ones share a rank.

    Four symbols at a time. One that ends where another goes on is the larger one, as the other falls there.
    """
    ends = np.append(at[1:], at[-1]) + 1

    def packed(which, skip):
        key = np.zeros(len(which), np.uint64)
        for k in range(skip, skip + 4):
            pos = at[which] + k
            key = (key << np.uint64(16)) | np.where(pos < ends[which], t[np.minimum(pos, len(t) - 1)], 0xFFFF).astype(np.uint64)
        return key

    name = np.unique(packed(np.arange(len(at)), 0), return_inverse=True)[1]
    skip = 4
    while True:
        again = np.zeros(int(name.max()) + 1, bool)
        again[name[ends - at > skip]] = True
        again &= np.bincount(name) > 1
        some = np.flatnonzero(again[name])
        if not len(some):
            return name
        key = packed(some, skip)
        some = some[order := np.lexsort((key, name[some]))]
        key, group = key[order], name[some]
        opens = np.append(True, group[1:] != group[:-1])
        steps = np.cumsum(opens | np.append(True, key[1:] != key[:-1]))
        within = steps - steps[np.maximum.accumulate(np.where(opens, np.arange(len(some)), 0))]
        extra = np.zeros(len(again), np.int64)
        closes = np.append(opens[1:], True)
        extra[group[closes]] = within[closes]
        name = name + (np.cumsum(extra) - extra)[name]
        name[some] += within
        skip += 4


def _doubled(name: np.ndarray) -> np.ndarray:
    """Suffixes of names in order, by ranks of runs twice as long each time; the last name is less than all others."""
    rank, size = name.astype(np.int64), 1
    while rank.max() + 1 < len(rank):
        after = np.append(rank[size:] + 1, np.zeros(min(size, len(rank)), np.int64))[: len(rank)]
        rank = np.unique(rank << 32 | after, return_inverse=True)[1]
        size *= 2
    return np.argsort(rank)


def _first_sorted(t: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The S*-suffixes in order, each with the symbols it shares with the one before."""
    name = _names(t, at)
    count, m = int(name.max()) + 1, len(at)
    width = 1 if count <= FEW else 2
    if count == m:
        order, shared = np.argsort(name), np.zeros(m, np.int64)
    elif m <= SMALL or width * m > 0.9 * len(t):
        order = _doubled(name)
        shared = np.append(0, _longer(name, order[:-1], order[1:], np.zeros(m - 1, np.int64)))
    else:
        base = count if width == 1 else int(np.ceil(np.sqrt(count)))
        digits = room(width * m + 1, np.uint16)
        digits[width - 1 : -1 : width] = name % base + 1
        if width == 2:
            digits[0:-1:2] = name // base + 1
        del name
        pos, value = sorted_suffixes(digits)
        mine = np.flatnonzero((pos % width == 0) & (pos < width * m))
        order = pos[mine] // width
        shared = np.minimum.reduceat(value, np.append(0, mine[:-1] + 1)).astype(np.int64) // width
        shared[0] = 0
    p, q = at[order[:-1]], at[order[1:]]
    known = at[order[1:] + shared[1:]] - q if len(at) > 1 else shared[1:]
    return at[order], np.append(0, _longer(t, p, q, known)).astype(np.int32)


def _scan(u: np.ndarray, symbols: int, member: np.ndarray, seeds: np.ndarray, values: np.ndarray):
    """All member suffixes in ascending order of u, induced from the seeds, which come after the members of their first symbol.

    Positions, values and the bounds of each symbol's region, and the value between a symbol's last member and its first seed.
    """
    count = np.zeros(symbols, np.int64)
    for low in range(0, len(u), CHUNK):
        count += np.bincount(u[low : low + CHUNK][member[low : low + CHUNK]], minlength=symbols)
    start = np.append(0, np.cumsum(count))
    queue, prefix = room(int(start[-1]), np.int64), room(int(start[-1]), np.int32)
    filled = start[:-1].copy()
    since = np.zeros(symbols, np.int32)  # the least value passed since a symbol was put last
    seam = np.zeros(symbols, np.int32)
    borders = np.append(0, np.cumsum(np.bincount(u[seeds], minlength=symbols)))

    def put(pos, value):
        before = pos - 1
        k = np.flatnonzero((pos > 0) & member[before])
        if not len(k):
            np.minimum(since, value.min(), out=since)
            return
        under = u[before[k]]
        order = np.argsort(under, kind="stable")
        k, under = k[order], under[order]
        head = np.append(True, under[1:] != under[:-1])
        heads = np.flatnonzero(head)
        ends = np.append(heads[1:], len(k))
        passed, left = np.minimum.accumulate(value), np.append(np.minimum.accumulate(value[::-1])[::-1], _FAR)
        low = np.empty(len(k), np.int32)
        low[heads] = np.minimum(since[under[heads]], passed[k[heads]])
        rest = np.flatnonzero(~head)
        low[rest] = _least(value, k[rest - 1] + 1, k[rest])
        to = np.repeat(filled[under[heads]] - heads, ends - heads) + np.arange(len(k))
        queue[to], prefix[to] = before[k], low + 1
        filled[under[heads]] += ends - heads
        np.minimum(since, passed[-1], out=since)
        since[under[heads]] = left[k[ends - 1] + 1]

    for c in np.flatnonzero((count > 0) | (np.diff(borders) > 0)).tolist():
        at = int(start[c])
        if filled[c] > at:
            prefix[at] = 0
        while at < filled[c]:
            upto = min(int(filled[c]), at + CHUNK)
            put(np.array(queue[at:upto]), np.array(prefix[at:upto]))
            at = upto
        for low in range(int(borders[c]), int(borders[c + 1]), CHUNK):
            upto = min(int(borders[c + 1]), low + CHUNK)
            value = np.array(values[low:upto])
            if low == borders[c]:
                if count[c]:
                    seam[c] = _longer(u, queue[at - 1 : at], seeds[low : low + 1], np.zeros(1, np.int64))[0]
                value[0] = seam[c]
            put(np.array(seeds[low:upto]), value)
    return queue, prefix, start, seam


def sorted_suffixes(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes of t in order, and the symbols each shares with the one before it (0 for the first).

    t: uint16 below 65535; its last symbol is less than all others.
    """
    n, symbols = len(t), int(t.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int32)
    rising = _rising(t)
    at = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    seeds, values = _first_sorted(t, at)
    falling = _kept(~rising)
    down, shared, starts, _ = _scan(t, symbols, falling, seeds, values)
    del seeds, values, falling
    rising[-1] = False  # nothing comes before it; it is the first of all
    # Descending, the suffixes between one and the next are the same, so a value belongs to the later one of its pair.
    turned = _kept(np.append(0, shared[:0:-1]).astype(np.int32)) if len(shared) else shared
    up, common, begins, seam = _scan(symbols - 1 - t, symbols, rising, _kept(down[::-1]), turned)
    out, value = room(n, np.int64), room(n, np.int32)
    out[0], value[0] = n - 1, 0
    to = 1
    for c in range(symbols):
        a, b = int(starts[c]), int(starts[c + 1])
        out[to : to + b - a], value[to : to + b - a] = down[a:b], shared[a:b]
        to += b - a
        a, b = int(begins[symbols - 1 - c]), int(begins[symbols - c])
        if b > a:
            out[to : to + b - a] = up[a:b][::-1]
            value[to + 1 : to + b - a] = common[a + 1 : b][::-1]
            value[to] = seam[symbols - 1 - c]
            to += b - a
    return out, value
