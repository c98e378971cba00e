"""Operator 1: a hidden Markov language model.

Training: word counts of all training texts (a shuffle of per-task partial counts) give the unigram base and
the model's symbols: the HEAD commonest words are symbols of their own, all others fall into CLASSES classes by
their ending and have a unigram within their class. Baum-Welch then trains STATES latent states: each task runs
forward and backward over its whole texts and returns expected counts by symbol, which are summed across
partitions; the driver holds only the model, states by symbols. It ends when a round gains less than SETTLED log10 a
token; ROUNDS only stops a training that never does.

Scoring: the scaled forward recursion gives the exact likelihood of each whole text.

Long texts are cut into blocks that are worked on side by side. A first pass gives each block's transfer matrix;
their products are the exact forward and backward messages at the borders, for training and for scoring.

Counts of words beyond the KNOWN commonest come by a join; only they are shuffled, so no key is hot. Very long words stand
under a digest of theirs, so that a long word of every other text is among the commonest like any other.

Null and empty texts are the end alone. Repeated rows train and are scored as often as they occur; rows are told
apart by a number written down with them. A null id trains. Ties among equally common words at the edge of HEAD go to the lesser word. With nothing to train on, or an
empty table, scores are those of the priors. Other columns go no further.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, map_arrow

#: Symbols of single words, symbols of classes, latent states, rounds of Baum-Welch at most, gain a token below which it ends.
HEAD, CLASSES, STATES, ROUNDS, SETTLED = 8192, 256, 8, 30, 4e-3
#: Words whose counts are sent to every task: at most so many; those of more than WORD_BYTES bytes stand under a digest.
KNOWN, WORD_BYTES = 50_000, 64
#: Words seen more rarely stay in their class, so that classes know how rare words behave.
LEAST = 3
#: Tokens of a block of a long text; how many blocks make a text long; cells of a grid of tokens worked on at once.
BLOCK, LONG, AT_ONCE = 256, 16, 400_000
#: Weight of the unigram in each state's emissions, in tokens; smoothing of transitions.
PRIOR, STICK = 50.0, 0.9
END = b""


def is_held_out(doc_id) -> bool:
    """Texts that training leaves out: crc32 of the id as text, modulo 5, is 1. A null id is trained on."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def words_of(text: str) -> list[bytes]:
    """ASCII lower-case words between ASCII white space."""
    return text.encode().lower().split()


def key_of(word: bytes) -> bytes:
    """The word, or a digest with its last two bytes, which tell its class, where it is long."""
    return word if len(word) <= WORD_BYTES else b"\0" + xxhash.xxh3_128_digest(word) + word[-2:]


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def _count(batches):
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array(map(key_of, counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    counts: Counter = Counter()
    for b in batches:
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            if not is_held_out(i):
                counts.update(words_of(text))
                counts[END] += 1
        if len(counts) > 400_000:
            yield rows(counts)
            counts = Counter()
    yield rows(counts)


@dataclass
class Model:
    """Counts of the commonest words, the first HEAD of them symbols; corpus totals; the HMM's parameters; log10 likelihood a token before each round."""

    known: dict[bytes, int]
    tokens: int
    types: int
    class_z: np.ndarray
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states
    gains: list[float]

    @property
    def log_z(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.types + 1))

    @property
    def symbols(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(list(self.known)[:HEAD])}


def _padded(seqs: list[np.ndarray]):
    """Sequences by falling length as columns of a grid, how many are still running at each step, and their order."""
    lens = np.array([len(x) for x in seqs])
    order = np.argsort(-lens, kind="stable")
    lens = lens[order]
    grid = np.zeros((lens[0], len(seqs)), np.int64)
    for k, j in enumerate(order):
        grid[: lens[k], k] = seqs[j]
    return grid, np.searchsorted(-lens, -np.arange(lens[0]), side="left"), order


def _portions(seqs: list[np.ndarray]):
    """Positions of sequences, longest first, in portions whose grid has at most AT_ONCE cells, or one sequence."""
    part: list[int] = []
    for k in sorted(range(len(seqs)), key=lambda k: -len(seqs[k])):
        if part and len(seqs[part[0]]) * (len(part) + 1) > AT_ONCE:
            yield part
            part = []
        part.append(k)
    if part:
        yield part


def _cut(seqs: list[np.ndarray]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Blocks of the sequences, and (sequence, place) of each: short ones whole, long ones in pieces of BLOCK tokens."""
    long = lambda x: len(x) > LONG * BLOCK
    at = [(k, i) for k, x in enumerate(seqs) for i in range(0, len(x), BLOCK if long(x) else len(x))]
    return [seqs[k][i : i + BLOCK] if long(seqs[k]) else seqs[k] for k, i in at], at


def _transfer(blocks: list[np.ndarray], first: list[bool], start, move, emit):
    """Of each block: the matrix from the state before its first token to that of its last (all rows the start's in a first block), scaled, and log10 of the scale."""
    states = len(start)
    matrices, logs = np.zeros((len(blocks), states, states), emit.dtype), np.zeros(len(blocks))
    for part in _portions(blocks):
        grid, running, order = _padded([blocks[k] for k in part])
        at = [part[j] for j in order]
        m, opens = np.broadcast_to(np.eye(states, dtype=emit.dtype), (len(at), states, states)).copy(), np.array([first[k] for k in at])
        log = np.zeros(len(at))
        for t in range(len(grid)):
            n = running[t]
            x = (m[:n].reshape(-1, states) @ move).reshape(n, states, states)
            if t == 0 and opens.any():
                x[opens[:n]] = start
            x *= emit[grid[t, :n], None, :]
            s = x.sum((1, 2))
            log[:n] += np.log10(s)
            m[:n] = x / s[:, None, None]
        matrices[at], logs[at] = m, log
    return matrices, logs


def _messages(at: list[tuple[int, int]], blocks: list[np.ndarray], start, move, emit):
    """Exact messages of blocks of long sequences: weights of the state before each block's first emission, and after its last token."""
    states = len(start)
    first, last = np.empty((len(at), states), emit.dtype), np.ones((len(at), states), emit.dtype)
    first[:] = start
    long = [j for j, (k, i) in enumerate(at) if i > 0 or j + 1 < len(at) and at[j + 1][0] == k]
    if long:
        m, _ = _transfer([blocks[j] for j in long], [at[j][1] == 0 for j in long], start, move, emit)
        v = None
        for x, j in zip(m, long):
            if at[j][1]:
                first[j] = v @ move
            v = x[0] if at[j][1] == 0 else v @ x
            v = v / v.sum()
        for q in range(len(long) - 1, 0, -1):
            if at[long[q]][1]:
                u = m[q] @ last[long[q]]
                last[long[q - 1]] = u / u.sum()
    return first, last


def expected_counts(seqs: list[np.ndarray], start, move, emit):
    """Baum-Welch: expected starts, moves and emissions of whole sequences, and their log10 likelihood."""
    states = len(start)
    starts, moves, emissions, total = np.zeros(states), np.zeros((states, states)), np.zeros((len(emit), states)), 0.0
    blocks, at = _cut(seqs)
    first, last = _messages(at, blocks, start, move, emit)
    end, entry = np.zeros((len(at), states), emit.dtype), np.zeros((len(at), states), emit.dtype)
    back = np.ascontiguousarray(move.T)
    for part in _portions(blocks):
        grid, running, order = _padded([blocks[k] for k in part])
        own = [part[j] for j in order]
        steps, width = grid.shape
        alpha, scale = np.zeros((steps, width, states), emit.dtype), np.ones((steps, width), emit.dtype)
        a = first[own] * emit[grid[0]]
        for t in range(steps):
            n = running[t]
            if t:
                a = (alpha[t - 1, :n] @ move) * emit[grid[t, :n]]
            s = a.sum(1)
            scale[t, :n] = s
            alpha[t, :n] = a / s[:, None]
        total += float(np.log10(scale, dtype=float).sum())
        end[own] = alpha[[len(blocks[k]) - 1 for k in own], np.arange(width)]
        beta = last[own] / (end[own] * last[own]).sum(1, keepdims=True)
        for t in range(steps - 1, -1, -1):
            n = running[t + 1] if t + 1 < steps else 0
            if n:
                e = emit[grid[t + 1, :n]] * beta[:n] / scale[t + 1, :n, None]
                moves += alpha[t, :n].T @ e
                beta[:n] = e @ back
            alpha[t, : running[t]] *= beta[: running[t]]
        mask = np.arange(width)[None, :] < running[:, None]
        seen, gamma = grid[mask], alpha[mask]
        emissions += np.stack([np.bincount(seen, gamma[:, s], len(emit)) for s in range(states)], 1)
        entry[own] = emit[grid[0]] * beta / scale[0][:, None]
        starts += alpha[0][[at[k][1] == 0 for k in own]].sum(0)
    inner = [j for j, (_, i) in enumerate(at) if i]
    if inner:  # moves over the borders of blocks
        moves += end[[j - 1 for j in inner]].T.astype(float) @ entry[inner]
    return starts, moves * move, emissions, total


def log_forward(seqs: list[np.ndarray], start, move, emit) -> np.ndarray:
    """log10 likelihood of each sequence (none of them empty) by the scaled forward recursion."""
    out = np.zeros(len(seqs))
    blocks, at = _cut(seqs)
    short = [j for j, (k, i) in enumerate(at) if len(blocks[j]) == len(seqs[k])]
    for part in _portions([blocks[j] for j in short]):
        grid, running, order = _padded([blocks[short[k]] for k in part])
        logs = np.zeros(grid.shape[1])
        a = start * emit[grid[0]]
        for t in range(len(grid)):
            n = running[t]
            if t:
                a = (a[:n] @ move) * emit[grid[t, :n]]
            s = a.sum(1)
            logs[:n] += np.log10(s)
            a = a / s[:, None]
        out[[at[short[part[j]]][0] for j in order]] = logs
    long = sorted(set(range(len(at))) - set(short))
    if long:
        m, logs = _transfer([blocks[j] for j in long], [at[j][1] == 0 for j in long], start, move, emit)
        v = None
        for x, log, j in zip(m, logs, long):
            k, i = at[j]
            v = x[0] * len(start) if i == 0 else v @ x
            s = v.sum()
            out[k] += log + math.log10(s) - (math.log10(len(start)) if i == 0 else 0.0)
            v = v / s
    return out


class _Index(dict):
    """word -> its place among the known words, or -1."""

    def __missing__(self, word):
        return -1


def _encode(known: dict, log_z: float, class_z: np.ndarray):
    """key, doc_id, held_out, n_tokens, symbols, what common words add to both scores, and the rest to be looked up."""
    schema = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("inner", pa.float64()), ("ids", pa.binary()), ("rest", pa.list_(pa.binary()))]
    )
    log_class = np.log10(class_z)

    def run(batches):
        from pyspark import TaskContext

        place = _Index({w: k for k, w in enumerate(known)}).__getitem__
        counts = np.array(list(known.values()), float)
        classes = np.array([word_class(w) for w in known])
        symbol = np.where(np.arange(len(known)) < HEAD, np.arange(len(known)), HEAD + classes).astype(np.uint16)
        logs = np.log10(counts + 0.5)
        inner_of = np.where(np.arange(len(known)) < HEAD, 0.0, logs - log_class[classes])
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = words_of(text)
                words.append(END)
                where = np.fromiter(map(place, words), np.int64, len(words))
                for k in np.flatnonzero(where < 0).tolist():
                    if len(words[k]) > WORD_BYTES:
                        words[k] = key_of(words[k])
                        where[k] = place(words[k])
                new = np.flatnonzero(where < 0)
                rest = [words[k] for k in new.tolist()]
                ids = symbol[where]
                base, inner = float(logs[where].sum()), float(inner_of[where].sum())
                if rest:  # place -1 has counted the last known word for each of them
                    of = np.fromiter(map(word_class, rest), np.int64, len(rest))
                    ids[new] = HEAD + of
                    base, inner = base - len(rest) * logs[-1], inner - len(rest) * inner_of[-1] - float(log_class[of].sum())
                n_known = len(words) - len(rest) - (counts[0] == 0)
                for c, v in zip(cols, (at, i, is_held_out(i), len(words), int(n_known), base - len(words) * log_z, inner, ids.tobytes(), rest)):
                    c.append(v)
                at += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _expect(start, move, emit):
    """Expected counts of a task's texts: rows of (symbol, counts by state); below 0 starts, moves, and log10 likelihood with tokens."""
    states = len(start)
    schema = pa.schema([("symbol", pa.int32())] + [(f"s{k}", pa.float64()) for k in range(states)])

    def run(batches):
        starts, moves, emissions, likely = np.zeros(states), np.zeros((states, states)), np.zeros((len(emit), states)), np.zeros(states)
        for b in batches:
            if seqs := [np.frombuffer(data, "<u2") for data in b.column("ids").to_pylist()]:
                x, y, z, total = expected_counts(seqs, start, move, emit)
                starts += x
                moves += y
                emissions += z
                likely[:2] += total, sum(map(len, seqs))
        at = np.flatnonzero(emissions.any(1))
        symbols = np.concatenate([[-1], -2 - np.arange(states), [-2 - states], at]).astype(np.int32)
        values = np.concatenate([starts[None], moves, likely[None], emissions[at]])
        yield pa.RecordBatch.from_arrays([pa.array(symbols), *(pa.array(np.ascontiguousarray(values[:, k])) for k in range(states))], schema=schema)

    return run


def first_guess(counts: np.ndarray, states: int = STATES):
    """Start, moves and emissions before training: the unigram with fixed noise, states that tend to stay."""
    p = (counts + 0.5) / (counts.sum() + 0.5 * len(counts))
    x = np.arange(1, len(counts) * states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    noise = ((x >> np.uint64(40)) / float(1 << 24)).reshape(len(counts), states)
    emit = p[:, None] * np.exp(1.5 * noise)
    move = np.full((states, states), (1 - STICK) / (states - 1))
    np.fill_diagonal(move, STICK)
    return np.full(states, 1 / states), move, emit / emit.sum(0)


def improved(sums: dict, states: int, unigram: np.ndarray):
    """The next model from summed expected counts; each state's emissions lean on the unigram."""
    emissions = np.zeros((len(unigram), states))
    for symbol, values in sums.items():
        if symbol >= 0:
            emissions[symbol] = values
    emit = (emissions + PRIOR * unigram[:, None]) / (emissions.sum(0) + PRIOR)
    start = sums.get(-1, np.zeros(states)) + 1.0
    move = np.stack([sums.get(-2 - k, np.zeros(states)) for k in range(states)]) + 1.0
    return start / start.sum(), move / move.sum(1, keepdims=True), emit


def train(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the texts that is_held_out() leaves; every text in symbols; the counts of all words. Takes two states or more."""
    texts = id_and_text(docs, id_col, text_col)
    counted = map_arrow(texts, _count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    vocab = scratch.write(counted, "vocab")
    by_class = F.pmod(F.crc32(F.expr("case when octet_length(word) > 2 then substring(word, -2, 2) else word end")), F.lit(CLASSES)).cast("int")
    common = vocab.where((F.octet_length("word") > 0) & (F.col("c") >= LEAST))
    # By sixteenths of a doubling: the commonest bins that hold KNOWN words at most, found without a sort.
    common = common.withColumn("bin", F.floor(16 * F.log2("c")).cast("int"))
    left, least = KNOWN - 1, 10_000
    for bin_, n in sorted(common.groupBy("bin").count().collect(), reverse=True):
        if n > left:
            break
        left, least = left - n, bin_
    ends = vocab.where(F.octet_length("word") == 0).agg(F.sum("c")).first()[0]
    top = common.where(F.col("bin") >= least).select("word", "c").collect()
    # The end comes first, and is there even if nothing was trained on.
    known = {END: int(ends or 0)} | {bytes(r.word): r.c for r in sorted(top, key=lambda r: (-r.c, r.word))}
    sums = {r[0]: (r[1], r[2]) for r in vocab.groupBy(by_class.alias("k")).agg(F.sum("c"), F.count(F.lit(1))).collect()}
    tokens, types = (int(sum(x[j] for x in sums.values())) for j in (0, 1))
    # Within a class: the words that aren't symbols, and one share for words never seen.
    inside, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (c, n) in sums.items():
        inside[k], kinds[k] = c, n
    counts = np.zeros(HEAD + CLASSES)
    for k, w in enumerate(list(known)[:HEAD]):
        inside[word_class(w)] -= known[w]
        kinds[word_class(w)] -= known[w] > 0
        counts[k] = known[w]
    counts[HEAD:] = inside
    model = Model(known, tokens, types, inside + 0.5 * (kinds + 1), *first_guess(counts, states), [])
    schema = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, ids binary, rest array<binary>"
    coded = scratch.write(map_arrow(texts, _encode(known, model.log_z, model.class_z), schema), "coded")

    unigram = (counts + 0.5) / (counts.sum() + 0.5 * len(counts))
    seqs = coded.where("not held_out").select("ids")
    fields = "symbol int, " + ", ".join(f"s{k} double" for k in range(states))
    for _ in range(rounds):
        guess = [x.astype(np.float32) for x in (model.start, model.move, model.emit)]
        rows = map_arrow(seqs, _expect(*guess), fields).groupBy("symbol").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)])
        # At most one row a symbol, HEAD + CLASSES + states + 2 in all.
        found = {r[0]: np.array(r[1:]) for r in rows.collect()}
        total, n = found.get(-2 - states, np.zeros(2))[:2]
        if n == 0:
            break
        model.gains.append(float(total / n))
        model.start, model.move, model.emit = improved(found, states, unigram)
        if len(model.gains) > 1 and model.gains[-1] - model.gains[-2] < SETTLED:
            break
    return model, coded, vocab


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Train on the texts that is_held_out() leaves, score all.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of docs. Scores
    are log10 probabilities of the words and one end.
    """
    model, coded, vocab = train(docs, Scratch(docs.sparkSession, "hmm"), id_col, text_col, states, rounds)
    parameters = model.start, model.move, model.emit
    out = pa.schema([("key", pa.int64()), ("forward", pa.float64())])

    def forward(batches):
        for b in batches:
            seqs = [np.frombuffer(x, "<u2") for x in b.column("ids").to_pylist()]
            if seqs:
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(log_forward(seqs, *parameters))], schema=out)

    run = map_arrow(coded.select("key", "ids"), forward, "key long, forward double")
    # What the forward pass and the lookup of rare words find meets the row's own numbers by its key.
    rare = coded.select("key", F.explode("rest").alias("word")).join(vocab.hint("shuffle_hash"), "word", "left")
    found = rare.groupBy("key").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare"), F.count("c").alias("rare_known"))
    none = F.lit(None)
    parts = (
        coded.select("key", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner", none.cast("double").alias("forward"), none.cast("double").alias("rare"), none.cast("long").alias("rare_known"))
        .unionByName(run, allowMissingColumns=True)
        .unionByName(found, allowMissingColumns=True)
    )
    names = [c for c in parts.columns if c != "key"]
    rows = parts.groupBy("key").agg(*[F.max(c).alias(c) for c in names])
    rare_sum = F.coalesce("rare", F.lit(0.0))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_sum).alias("base_score"), (F.col("forward") + F.col("inner") + rare_sum).alias("score"),
    )
