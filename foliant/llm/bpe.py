"""Operator 10: BPE encoding and decoding with forced-boundary splitting.

Byte pairs that occur inside no vocabulary token mark certain cuts; the fragments between them are encoded
independently and the ids concatenated (``tokens.WordBpe``). One pass over the rows, no shuffle; a worker
keeps a bounded cache of what it has encoded.

Null and empty texts have no ids. Repeated rows repeat, in any order; nothing depends on ties. An empty table gives no
rows. Texts of any length are encoded whole. Other columns go no further.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, map_arrow, records
from .tokens import vocabulary, word_bpe

VOCABULARY = "word_bpe_49k.json"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of every row. Null and empty texts have no ids; repeated rows repeat."""
    path = path or vocabulary(VOCABULARY)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            ids = [[int(i) for i in bpe.encode(t)[1].split()] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, schema.field("ids").type)], schema=schema)

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of every row of encode(): the tokens joined by one space, as the library without a decoder."""
    path = path or vocabulary(VOCABULARY)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        names = word_bpe(path).names
        for b in batches:
            texts = [" ".join([names[i] for i in ids or ()]) for ids in b.column("ids").to_pylist()]
            yield records(schema, {"doc_id": b.column("doc_id"), "text": texts})

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, without the arrays between."""
    path = path or vocabulary(VOCABULARY)
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe, sha = word_bpe(path), hashlib.sha256
        for b in batches:
            found = [bpe.encode(t) for t in b.column("text").to_pylist()]
            yield records(
                out,
                {
                    "doc_id": b.column("doc_id"),
                    "n_tokens": [n for n, _, _ in found],
                    "ids_sha256": [sha(i.encode()).hexdigest() for _, i, _ in found],
                    "decoded_sha256": [sha(d.encode()).hexdigest() for _, _, d in found],
                },
            )

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
