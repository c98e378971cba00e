"""Suffix-array de-duplication, the filter audit and lexical search against brute force, odd rows included."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import filter_audit, hmm, lexical, packing, registry, suffix_dedup, suffixes
from foliant.llm.common import Scratch

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, id long, tag long, `text ` string, key long, h long, part string, good int, A string"


def table_of(spark, rows):
    """rows (doc_id, text, lang) beside columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, p, 1, 2, "x", 3, 4, "y", 5, "z") for i, t, p in rows], SCHEMA)


def plain_suffixes(t):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    shared = [0]
    for a, b in itertools.pairwise(order):
        k = 0
        while t[a + k] == t[b + k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("spill", [0, 1 << 26])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
@pytest.mark.parametrize("few, small", [(0, 0), (1024, 0), (3, 6), (1024, 1 << 20)])
def test_suffixes_against_plain_sort(monkeypatch, spill, chunk, few, small):
    for name, value in (("SPILL", spill), ("CHUNK", chunk), ("FEW", few), ("SMALL", small)):
        monkeypatch.setattr(suffixes, name, value)
    rng = random.Random(chunk + few + small)
    for _ in range(60):
        n, kinds = rng.randint(0, 80), rng.choice([1, 2, 3, 5, 300])
        own = [rng.randint(1, kinds) for _ in range(rng.choice([n, n, 4]) or 1)]
        t = ((own * 80)[:n]) + [0]
        order, shared = suffixes.sorted_suffixes(np.array(t, np.uint16))
        assert (order.tolist(), shared.tolist()) == plain_suffixes(t)


def plain_repeats(rows, length):
    texts = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for (doc_id, _, _), x in zip(rows, texts):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((doc_id, len(x), [tuple(e) for e in edges.reshape(-1, 2).tolist()], hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Texts that share passages, whole and in part, periodic ones, copies, repeats within a text, odd rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (4, 8, 12, 30)]
    rows = [(k, prose(rng.randint(0, 30)) + rng.choice(shared) + prose(rng.randint(0, 20)) + rng.choice(["", rng.choice(shared)]), "en") for k in range(60)]
    rows += [(100 + k, rows[k][1], "de") for k in range(8)]
    rows += [(200, "ab" * 70, "en"), (201, "a" * 90, None), (202, None, "en"), (203, "", "en"), (204, "a" * 25, "en"), (205, "x" * 3 + "a" * 25 + "y", "en"), (206, shared[3] + shared[3], "en")]
    return [*rows, (None, rows[3][1], "en"), (None, "only here " * 3, "en"), (5, rows[5][1], "en"), (5, "another text of one id", "en")]


@pytest.mark.parametrize("many, shard", [(2000, 8 << 20), (2, 2000), (0, 500)])
def test_repeats_against_plain_count(spark, many, shard):
    rows = passages(many)
    docs = table_of(spark, rows)
    for length in (24, 60):
        found = suffix_dedup.without_repeats(docs, length, many=many, shard=shard)
        got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
        assert sorted(got, key=str) == plain_repeats(rows, length)
    assert suffix_dedup.without_repeats(docs.limit(0)).collect() == []


def test_repeats_query_against_plain_count(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = plain_repeats(rows, 400)
    got = registry.QUERIES["op11_suffix_dedup"](spark, DATA).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_spans, r.kept_sha256) for r in got), key=str) == [(i, n, len(s), h) for i, n, s, h in want]
    removed = {i: sum(b - a for a, b in s) for i, _, s, _ in want}
    assert {r.doc_id: r.n_removed for r in got} == removed and any(removed.values())


def test_every_window_has_an_anchor_of_its_bytes():
    rng = random.Random(7)
    passage = bytes(rng.randrange(97, 123) for _ in range(150))
    anchors = []
    for _ in range(2):
        text = bytes(rng.randrange(97, 123) for _ in range(rng.randint(0, 90))) + passage + b"!"
        lo, windows, h = suffix_dedup.segments(text, 60, 24)
        assert lo[0] == 0 and (lo[:-1] + windows[:-1] == lo[1:]).all() and lo[-1] + windows[-1] == len(text) - 59
        of = np.repeat(h, windows)
        anchors.append(of[text.index(passage) : text.index(passage) + 91].tolist())
    assert anchors[0] == anchors[1]


AUDITED = [
    (1, " ".join(f"w{k}" for k in range(120)), "en"), (2, " ".join(f"w{k}" for k in range(120)), "en"), (3, "the the " * 80, "en"), (4, "ABC DEF", "de"), (5, "mark # here", "de"),
    (6, None, None), (7, "", "de"), (8, " \n", "en"), (9, "the the " * 80, "fr"), (9, "the the " * 80, "fr"), (None, "the the " * 80, "fr"), (None, "x", "fr"), (10, "ÉÉÉ \U0001f600", "fr"), (11, "A$ " + "b " * 200, "en"),
]
MARKED = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (4, 1, 0), (5, 0, 1), (7, 1, 0), (9, 1, 1), (None, 1, 1), (77, 1, 1)]


def plain_audit(rows, labels):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    texts = [(i, t or "", p or "") for i, t, p in rows]
    marks = {}
    for i, q, x in labels:
        if i is not None:
            q0, x0 = marks.get(i, (1, 0))
            marks[i] = min(q, q0), max(x, x0)
    docs = []
    for i, t, p in texts:
        w = words(t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(u == t and j is not None and j < i for j, u, _ in texts),
        }
        q, x = marks.get(i, (0, 0))
        docs.append((p, fails, q == 1, x == 1))
    out = []
    for part in {d[0] for d in docs}:
        own, taken, steps = [d for d in docs if d[0] == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                taken[f] += len(gone)
                fails = [d for d in own if d[1][f]]
                only = sum(sum(d[1].values()) == 1 for d in fails)
                steps.append((part, "".join(order), step, len(left), len(gone), len(fails) - len(gone), only, sum(d[2] for d in gone), sum(d[3] for d in gone), f))
        out += [(*s[:-1], taken[s[-1]]) for s in steps]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_against_plain_filters(spark):
    docs, labels = table_of(spark, AUDITED), spark.createDataFrame(MARKED, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, labels).select(AUDIT).collect()
    assert sorted(map(tuple, got)) == plain_audit(AUDITED, MARKED)
    assert filter_audit.filter_audit(docs.limit(0), labels).collect() == []
    none = filter_audit.filter_audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0")
    assert none.isEmpty()


def test_states_are_shared_between_orders(spark):
    rows, names = filter_audit.verdicts(table_of(spark, AUDITED), spark.createDataFrame(MARKED, "doc_id long, quality int, toxic int"))
    found = filter_audit.edges(rows, names, Scratch(spark, "edges"))
    whole = found.where("part = 'en'")
    assert found.select("state").distinct().count() <= 31 and found.groupBy("part", "state", "filter").count().where("count > 1").isEmpty()
    assert whole.where("state = 0").count() == 5 and not spark.sparkContext._jsc.getPersistentRDDs()


def test_audit_of_other_filters(spark):
    """Any filters of a text, without copies."""
    how = {"filters": lambda t: {"short": F.length(t) < 5, "digit": t.rlike("[0-9]")}, "copies": None}
    got = filter_audit.filter_audit(table_of(spark, [(1, "ab1", "x"), (2, "abcdef1", "x"), (3, "ab", "x"), (4, "abcdef", "x")]), spark.createDataFrame(MARKED, "doc_id long, quality int, toxic int"), **how)
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in got.collect()} == {
        ("shortdigit", 1): (2, 2, 3), ("shortdigit", 2): (1, 1, 3), ("digitshort", 1): (2, 2, 3), ("digitshort", 2): (1, 1, 3),
    }


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_rank(docs, queries, k=10):
    cut = lambda t: TERM.findall((t or "").translate(LOWER))
    docs = [(i, Counter(w), len(w)) for i, t in docs if (w := cut(t))]
    n_docs, n_terms, df = len(docs), sum(n for _, _, n in docs), Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(queries):
        scored = []
        for i, c, n in docs:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in cut(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, at, None if none else i, -score) for at, (score, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def searched(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["Été", "日本", "a_b", "x-y", "\U0001f600z"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    prose = lambda n: rng.choice([" ", "  ", ". "]).join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weights, k=n))
    docs = [(k, prose(rng.choice([1, 5, 20, 60, 400]))) for k in range(150)]
    docs += [(200 + k, docs[0][1]) for k in range(30)] + [(300, None), (301, ""), (302, "..."), (None, "w1 w2 w3"), (7, docs[7][1]), (7, "w50 w60")]
    queries = [(k, prose(rng.choice([1, 2, 6, 25]))) for k in range(25)]
    return docs, [*queries, (50, None), (51, "--"), (52, "nowhere at all"), (53, docs[0][1]), (3, queries[3][1]), (3, "w1 w1 w1 w99"), (None, "w1 w7")]


@pytest.mark.parametrize("sent", [200_000, 0])
def test_search_against_plain_scores(spark, monkeypatch, sent):
    monkeypatch.setattr(lexical, "SENT_TERMS", sent)
    docs, queries = searched(sent)
    a = table_of(spark, [(i, t, "en") for i, t in docs])
    b = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in queries], "item_id long, text string, key long, item long, term string")
    for k in (10, 3):
        got = [(r.item_id, r.rank, r.doc_id, r.score) for r in lexical.rank(a, b, k).collect()]
        assert sorted(got, key=str) == plain_rank(docs, queries, k)
    assert lexical.rank(a.limit(0), b).collect() == [] and lexical.rank(a, b.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_lexical_search"])
def test_new_queries_against_sql(spark, name):
    got = registry.QUERIES[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(registry.ORACLES[name])
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_ranges_of_the_curve_hold_as_many_tokens(spark):
    rng = random.Random(11)
    rows = [(k, rng.randrange(1 << 40), rng.choice([3, 50, 400])) for k in range(4000)] + [(k, (1 << 47) + k, 30_000) for k in range(60)] + [(k, 1 << 46, 2000) for k in range(900)]
    at = packing.borders(spark.createDataFrame(rows, "doc_id long, key long, n long"), 8)
    hashes = np.array([rng.randrange(1 << 24) for _ in rows])
    parts = packing.ranges_of(np.array([r[1] for r in rows]), hashes, at)
    sizes = Counter()
    for part, (_, _, n) in zip(parts.tolist(), rows):
        sizes[part] += n
    assert len(sizes) == 8 and max(sizes.values()) <= 1.5 * sum(sizes.values()) / 8
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], hashes[i]))
    assert (np.diff(parts[order]) >= 0).all()
    assert packing.borders(spark.createDataFrame(rows, "doc_id long, key long, n long").limit(0), 8) == []


def test_a_long_word_of_every_text_is_known(spark):
    line, other = "-" * 80, "=" * 90
    docs = spark.createDataFrame([(k, f"{line} word{k} {line}" + (f" {other}" if k == 3 else "")) for k in range(60)], "doc_id long, text string")
    model, coded, _ = hmm.train(docs, Scratch(spark, "long"), states=2, rounds=1)
    trained = sum(not hmm.is_held_out(k) for k in range(60))
    assert model.known[hmm.key_of(line.encode())] == 2 * trained
    rest = [bytes(w) for r in coded.select("rest").collect() for w in r.rest]
    assert hmm.key_of(line.encode()) not in rest and max(map(len, rest)) <= hmm.WORD_BYTES
    scored = {r.doc_id: r for r in hmm.score(docs, states=2, rounds=1).collect()}
    base = lambda c: math.log10((c + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
    for k in range(60):
        own = 0 if hmm.is_held_out(k) else 1
        want = 2 * base(2 * trained) + base(own) + base(trained) + (base(own) if k == 3 else 0)
        assert math.isclose(scored[k].base_score, want, rel_tol=1e-9) and scored[k].n_known == 3 + own * (2 if k == 3 else 1)
