"""Operator 4: unigram token counts by dynamic programming shared along a trie.

The distinct pre-tokens of a batch are walked in sorted order, which is the depth-first order of their trie:
one frame a depth holds the best unigram score and token count of the prefix there, so each prefix is scored
once for all pre-tokens that share it, and a pre-token's count is stored where it ends. Memory is the longest
pre-token plus a bounded cache.

The vocabulary's file has no unigram probabilities, so these are fitted to the corpus, the pieces being kept as they are: the distinct words of all
texts and their counts come by a shuffle of partial counts; each round segments them with the probabilities so far, along the same trie,
and the pieces' counts, summed across partitions, give the next (hard EM, half a count added to every piece).

Null and empty texts have 0 words and tokens; repeated rows repeat, and count as often in fitting. Ties go to
the longer last piece. An empty table gives no rows. Texts and words of any length are counted whole. Other columns go no
further.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, map_arrow, records
from .tokens import PieceScores, piece_scores, pieces_of, rank_logs, vocabulary

VOCABULARY = "piece_bpe_32k.model"
START = "\u2581"
#: Rounds of fitting; words that a worker holds at once.
ROUNDS, HELD = 3, 400_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def trie_counts(words: list[str], model: PieceScores, weights: dict[str, int] | None = None, used: np.ndarray | None = None) -> dict[str, int]:
    """Tokens in the most likely segmentation of each word; ties go to the longer last piece.

    With weights, each word's pieces are added to used as often as its weight says.
    """
    out: dict[str, int] = {}
    back, byte, place = model.back, model.byte, model.place
    frames: list[tuple[float, int, int]] = [(0.0, 0, -1)]  # score, tokens, where the last token begins (-1: bytes)
    last = ""
    for word in sorted(words):
        shared, most = 0, min(len(last), len(word))
        while shared < most and last[shared] == word[shared]:
            shared += 1
        del frames[shared + 1 :]
        for end in range(shared, len(word)):
            char = word[end]
            n = 1 if char < "\x80" else 2 if char < "\u0800" else 3 if char < "\U00010000" else 4
            score, count, _ = frames[end]
            best, fewest, begin = score + n * byte, count + n, -1
            node, k = back, end
            while k >= 0:
                node = node.get(word[k])
                if node is None:
                    break
                s = node.get("")
                if s is not None and (s := frames[k][0] + s) >= best:
                    best, fewest, begin = s, frames[k][1] + 1, k
                k -= 1
            frames.append((best, fewest, begin))
        out[word] = frames[-1][1]
        if weights is not None:
            end, weight = len(word), weights[word]
            while end:
                begin = frames[end][2]
                if begin >= 0:
                    used[place[word[begin:end]]] += weight
                end = begin if begin >= 0 else end - 1
        last = word
    return out


def _words(batches):
    schema = pa.schema([("word", pa.string()), ("c", pa.int64())])
    counts: Counter = Counter()
    for b in batches:
        for text in b.column("text").to_pylist():
            counts.update(_WORD.findall(text))
        if len(counts) > HELD:
            yield records(schema, {"word": list(counts), "c": list(counts.values())})
            counts = Counter()
    yield records(schema, {"word": list(counts), "c": list(counts.values())})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """Log-probabilities of the vocabulary's pieces, in its order, fitted to the texts."""
    path = path or vocabulary(VOCABULARY)
    scratch = Scratch(docs.sparkSession, "tokens")
    words = map_arrow(id_and_text(docs, id_col, text_col), _words, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    # Sorted, so that neighbours share their prefixes, whatever batches they come in.
    words = scratch.write(words.sortWithinPartitions("word"), "words")
    logs, schema = rank_logs(len(pieces_of(path))), pa.schema([("piece", pa.int32()), ("c", pa.float64())])

    def expect(now: bytes):
        def run(batches):
            model = piece_scores(path, now)
            used = np.zeros(len(model.place))
            for b in batches:
                trie_counts(list(own := {START + w: c for w, c in zip(b.column("word").to_pylist(), b.column("c").to_pylist())}), model, own, used)
            at = np.flatnonzero(used)
            yield records(schema, {"piece": at, "c": used[at]})

        return run

    for _ in range(rounds):
        # At most one row a piece.
        rows = map_arrow(words, expect(logs.tobytes()), "piece int, c double").groupBy("piece").agg(F.sum("c")).collect()
        counts = np.full(len(logs), 0.5)
        for piece, c in rows:
            counts[piece] += c
        logs = np.log(counts / counts.sum())
    scratch.drop()
    return logs


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, logs: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens (long) of every row; pre-tokens are words with a start mark. Without logs, they are fitted to docs."""
    path = path or vocabulary(VOCABULARY)
    fitted = (fit(docs, id_col, text_col, path) if logs is None else logs).tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        model = piece_scores(path, fitted)
        known = model.counts
        for b in batches:
            texts = [_WORD.findall(t) for t in b.column("text").to_pylist()]
            new = {w for words in texts for w in words if w not in known}
            fresh = {w[1:]: n for w, n in trie_counts([START + w for w in new], model).items()}
            if len(known) < HELD:
                known.update(fresh)
            counts = [sum([known[w] if w in known else fresh[w] for w in words]) for words in texts]
            yield records(schema, {"doc_id": b.column("doc_id"), "n_words": [len(x) for x in texts], "n_tokens": counts})

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, n_words long, n_tokens long")
