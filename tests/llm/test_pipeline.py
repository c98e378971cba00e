"""The corpus pipeline against a plain one, and its stages on odd rows."""

import itertools
import zlib
from collections import defaultdict

import duckdb
import pytest
from test_surrogates import plain

import corpus_pipeline
from foliant.llm import line_dedup, packing, pii, registry, tokens

DATA = "/root/testdata/sf0.001"
KEY = "a key of the tests"


def without_lines(docs):
    """{id: text} less the long lines that five documents or more have, but in the largest of them."""
    key = lambda x: x.strip(line_dedup.STRIP).translate({c: c + 32 for c in range(65, 91)})
    where = defaultdict(set)
    for i, x in docs.items():
        for line in x.split("\n"):
            if len(key(line)) >= line_dedup.MIN_CHARS:
                where[key(line)].add(i)
    gone = {k: max(ids) for k, ids in where.items() if len(ids) >= line_dedup.MIN_DOCS}
    return {i: "\n".join(line for line in x.split("\n") if gone.get(key(line), i) == i) for i, x in docs.items()}


def grams(x):
    w = x.encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def one_of_each(docs):
    root, sets = {i: i for i in docs}, {i: grams(x) for i, x in docs.items()}
    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return {i: x for i, x in docs.items() if root[i] == i}


def test_run_is_the_plain_pipeline(spark):
    from tokenizers import Tokenizer

    spark.conf.set(pii.KEY_SETTING, KEY)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    kept = {i for i, ok in con.sql(f"SELECT doc_id, kept FROM ({registry.ORACLES['op2_quality_rules']})").fetchall() if ok}
    docs = {i: x or "" for i, x in con.sql("SELECT doc_id, text FROM documents").fetchall() if i in kept}
    docs = one_of_each(without_lines(docs))
    ids = sorted(docs)
    docs = dict(zip(ids, (x for x, _ in plain([docs[i] for i in ids]))))
    tokenizer = Tokenizer.from_file(tokens.vocabulary(packing.VOCABULARY))
    want = {i: [*tokenizer.encode(x, add_special_tokens=False).ids, 1] for i, x in docs.items()}
    rows = corpus_pipeline.run(spark, DATA).collect()
    pieces = defaultdict(list)
    for r in rows:
        part = want[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(b"".join(t.to_bytes(4, "little") for t in part))
        pieces[r.doc_id].append((r.start, r.length))
    assert set(pieces) == set(want) and len(want) < len(kept)
    for i, of in pieces.items():
        assert sum(n for _, n in of) == len(want[i]) and all(s == sum(n for _, n in sorted(of)[:k]) for k, (s, _) in enumerate(sorted(of)))


TEXT, OTHER = (" ".join(f"{c}{k}x" for k in range(80)) for c in "wy")
ODD = [(1, TEXT, "en"), (1, TEXT, "en"), (2, None, "en"), (3, "", None), (None, f"other {TEXT} Mr. Smith a@b.cd", "en"), (None, OTHER, None), (5, " \n\t", "de"), (6, "x " * 30_000 + TEXT, "en")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, x, lang, "s", len(x or ""), "extra", 1, 2) for i, x, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, doc int, tag int")


@pytest.mark.parametrize("k, stage", list(enumerate(f for _, f in corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, odd, k, stage):
    out = stage(spark, odd, DATA)
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == corpus_pipeline.COLUMNS
    n = {0: 4, 1: len(ODD), 2: 5, 3: len(ODD)}.get(k)
    assert n is None or out.count() == n
    assert stage(spark, odd.limit(0), DATA).count() == 0
    if n is None:  # every row is packed, repeated ones as often as they occur
        assert sum(r.length for r in out.collect() if r.doc_id == 1) == 2 * next(r.doc_tokens for r in out.collect() if r.doc_id == 1)
