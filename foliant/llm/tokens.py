"""Encoders over the public vocabularies, with per-worker caches of what has been encoded before."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Entries of a worker's cache; common runs come first and stay, later rare ones are encoded anew.
CACHE = 300_000
#: Unicode White_Space, the \s of the libraries' regular expressions.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteBpe:
    """Ids of a byte-level BPE as the tokenizers library gives them, special tokens in the text included."""

    def __init__(self, path: str):
        import public_tokenizers as P
        import tiktoken

        spec = json.load(open(path))
        chars = _byte_chars()
        ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for token in self.special:
            ranks.pop(token.encode(), None)
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.split = re.compile("|".join(map(re.escape, self.special)))

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [*self.plain(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self.plain(text[at:])


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """BPE with word ends over forced fragments.

    A byte pair that occurs inside no vocabulary token can never be merged across, so each pre-token is cut
    there, the fragments are encoded independently and their ids joined. Fragments are kept by worker.
    """

    def __init__(self, path: str):
        import regex
        import tiktoken

        spec = json.load(open(path))
        model, chars = spec["model"], _byte_chars()
        self.names = {i: t for t, i in model["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        end = model["end_of_word_suffix"]
        # The word end stands as byte 255, which no UTF-8 text holds; joined to its byte before all else.
        raw = {i: self._raw(t, end, chars) for t, i in model["vocab"].items()}
        order = {**{c: k for k, c in enumerate(bytes([b]) for b in range(256))}}
        for b in range(255):
            order[bytes([b, 255])] = len(order)
        self.ids = {}
        by_token = {r: i for i, r in raw.items()}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            order.setdefault(self._raw(a + b, end, chars), len(order))
        for r, k in order.items():
            if r in by_token:
                self.ids[k] = by_token[r]
        self.single = tiktoken.Encoding("word_bpe", pat_str=r"\S+", mergeable_ranks=order, special_tokens={})._encode_single_piece
        inside = bytearray(65536)
        for r in raw.values():
            for x, y in zip(r, r[1:]):
                inside[x << 8 | y] = 1
        self.inside = bytes(inside)
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.split = re.compile("|".join(map(re.escape, self.special)))
        self.white = re.compile(f"[{WHITE}]+")
        self.plain = re.compile(r"[a-z]+").fullmatch
        self.fragments: dict[bytes, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}

    @staticmethod
    def _raw(token: str, end: str, chars: dict[str, int]) -> bytes:
        ended = token.endswith(end)
        return bytes(chars[c] for c in (token[: -len(end)] if ended else token)) + b"\xff" * ended

    def cuts(self, data: bytes) -> list[int]:
        """Where no token can span; the word end belongs to the last byte's symbol and is never cut off."""
        inside = self.inside
        return [k for k, (x, y) in enumerate(zip(data, data[1:-1]), 1) if not inside[x << 8 | y]]

    def pretoken(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        data = word.encode() + b"\xff"
        if not (cuts := self.cuts(data)):
            return [self.ids[k] for k in self.single(data)]
        out, at = [], 0
        for cut in [*cuts, len(data)]:
            piece = data[at:cut]
            at = cut
            ids = self.fragments.get(piece)
            if ids is None:
                ids = tuple([self.ids[k] for k in self.single(piece)])
                if len(self.fragments) < CACHE:
                    self.fragments[piece] = ids
            out += ids
        return out

    def chunk(self, x: str) -> tuple[int, str, str]:
        """A run without white space, lower-cased: number of ids, the ids and the tokens as text."""
        ids = self.pretoken(x) if self.plain(x) else [i for w in self.words(x) for i in self.pretoken(w)]
        found = (len(ids), " ".join([str(i) for i in ids]), " ".join([self.names[i] for i in ids]))
        if len(self.chunks) < CACHE:
            self.chunks[x] = found
        return found

    def normal(self, text: str) -> list[str]:
        """The runs without white space of a text after NFC and lower case, one character at a time."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return [x for x in self.white.sub(" ", text).lower().split(" ") if x]

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids and the decoded text, each joined by one space."""
        parts, at, get, make = [], 0, self.chunks.get, self.chunk
        if "<|" in text:
            for m in self.split.finditer(text):
                parts += [get(x) or make(x) for x in self.normal(text[at : m.start()])]
                parts.append((1, str(self.special[m[0]]), m[0]))
                at = m.end()
        parts += [get(x) or make(x) for x in self.normal(text[at:] if at else text)]
        return sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])


def pieces_of(path: str) -> list[str]:
    """The normal pieces of a SentencePiece file, in the file's order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def rank_logs(n: int) -> np.ndarray:
    """Log-probabilities by rank (Zipf), from which fitting starts: the file orders pieces by merge."""
    weight = 1.0 / np.arange(1, n + 1)
    return np.log(weight / weight.sum())


class PieceScores:
    """Pieces with unigram log-probabilities, as a trie of reversed pieces."""

    def __init__(self, pieces: list[str], logs: np.ndarray):
        self.scores = dict(zip(pieces, logs.tolist()))
        self.place = {p: k for k, p in enumerate(pieces)}
        #: A character outside the vocabulary costs one token a byte, each less likely than any piece.
        self.byte = float(logs.min()) - 10.0
        #: Token counts of words met before, up to a bound; a worker keeps them from task to task.
        self.counts: dict[str, int] = {}
        self.back: dict = {}
        for piece, s in self.scores.items():
            node = self.back
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = s


@lru_cache(maxsize=None)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=None)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def piece_scores(path: str, logs: bytes = b"") -> PieceScores:
    """logs: float64 log-probabilities in the order of pieces_of(path); by rank where there are none."""
    pieces = pieces_of(path)
    return PieceScores(pieces, np.frombuffer(logs) if logs else rank_logs(len(pieces)))
