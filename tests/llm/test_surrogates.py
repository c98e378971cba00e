"""Surrogates against a plain Python version, and the cases that patterns and draws have to survive."""

import hashlib
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from foliant.llm import pii

KEY = "a key of the tests"
FLAGS = regex.V1


def ascii_classes(pattern):
    """The digits and word characters of Java's patterns, which are ASCII."""
    out, inside = "", 0
    for token in regex.findall(r"\\.|.", pattern):
        inside += (token == "[") - (token == "]")
        found = {r"\d": "0-9", r"\w": "A-Za-z0-9_"}.get(token)
        out += token if not found else found if inside else f"[{found}]"
    return out


ANY = regex.compile(ascii_classes(pii.ANY), FLAGS)
KINDS = {k: regex.compile(ascii_classes(p), FLAGS) for k, p in pii.PATTERNS.items()}
CLASSES = [(regex.compile(ascii_classes(p), FLAGS), alphabet) for p, alphabet in pii.CLASSES]
TITLE = regex.compile(rf"({'|'.join(pii.TITLES['f'] + pii.TITLES['m'])})\.?\x20", FLAGS)


def canonical(kind, x):
    if kind in ("number", "phone", "card"):
        return "".join(c for c in x if c in "0123456789")
    return x.replace(" ", "") if kind == "account" else x.lower()


def parts(mention):
    """(kind, entity, lead, form) of each part."""
    kind = next((k for k, p in KINDS.items() if p.fullmatch(mention)), "person")
    if kind != "person":
        return [(kind, canonical(kind, mention), "", mention)]
    title = TITLE.match(mention)
    lead = title[0] if title else ""
    names = mention[len(lead) :].split(" ")
    family = ("family", names[-1].lower(), " " if len(names) > 1 else lead, names[-1])
    if len(names) == 1:
        return [family]
    given = names[0].lower()
    sex = ("f" if title[1] in pii.TITLES["f"] else "m") if title else ("f" if names[0] in pii.FEMALE else "m")
    known = given in [n.lower() for n in (pii.FEMALE if sex == "f" else pii.MALE)]
    return [(f"{'listed' if known else 'given'}_{sex}", given, lead, names[0]), family]


def surrogate(kind, entity, attempt):
    if kind.startswith("listed"):
        return pii.cycle(pii.FEMALE if kind[-1] == "f" else pii.MALE, KEY)[entity]
    h = hashlib.sha512("\x1f".join([KEY, kind, entity, str(attempt)]).encode()).hexdigest()
    byte = lambda i: int(h[i % 125 : i % 125 + 4], 16)
    pick = lambda alphabet, i: alphabet[byte(i) % len(alphabet)]

    def shape(x):
        return "".join(next((pick(a, i) for p, a in CLASSES if p.fullmatch(c)), c) for i, c in enumerate(x))

    extra = max(0, attempt - pii.GROW + 1)
    longer = lambda alphabet, by=0: "".join(pick(alphabet, k * 3 + 60) for k in range(1, extra + by + 1)) if extra else ""
    by_script = lambda choices: next(v for p, v in choices if regex.search(p, entity, FLAGS))
    letters, digits = longer(by_script(pii.LONGER)), longer("0123456789")
    if kind == "mail":
        tail = "." + entity.rsplit(".", 1)[1]
        return longer("aeiolnrst") + shape(entity)[: -len(tail)] + tail
    if kind == "address":
        return f"{byte(0) % 223 + 1}.{byte(4) % 256}.{byte(8) % 256}.{byte(12) % 254 + 1}" + (":" + longer("123456789", 3) if extra else "")
    if kind == "account":
        return entity[:2] + shape(entity)[2:] + digits
    if kind in ("phone", "card"):
        new = entity[0] + shape(entity)[1:] + digits
        return new[:-1] + str((10 - luhn(new[:-1] + "0")) % 10) if kind == "card" and luhn(entity) == 0 else new
    if kind == "number":
        return shape(entity) + digits
    if kind.startswith("given"):
        return shape(entity)[:-1] + letters + by_script(pii.ENDS[kind[-1]])
    return shape(entity) + letters


def luhn(digits):
    return sum(d - 9 if d > 9 else d for d in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10


def formatted(kind, form, new):
    if kind in ("number", "phone", "card"):
        rest = iter(new)
        return "".join(next(rest) if c in "0123456789" else c for c in form) + "".join(rest)
    if kind == "mail":
        return new if form == form.lower() else "".join(c.upper() if form[i : i + 1].isupper() else c for i, c in enumerate(new))
    if kind == "account":
        return " ".join(new[k : k + 4] for k in range(0, len(new), 4)) if " " in form else new
    return new if kind == "address" else new[0].upper() + new[1:]


def plain(texts):
    """Texts with surrogates and their mentions, drawn round by round as the operator promises."""
    found = [ANY.findall(x or "") for x in texts]
    assert all(isinstance(m, str) for f in found for m in f)
    entities = {p[:2] for f in found for m in f for p in parts(m)}
    done, todo = {}, {e: 0 for e in entities if not e[0].startswith("listed")}
    names = {n.lower() for n in pii.FEMALE + pii.MALE}
    while todo:
        taken = entities | {(k, new) for (k, _), new in done.items()}
        drawn = defaultdict(list)
        for (kind, entity), attempt in todo.items():
            drawn[kind, surrogate(kind, entity, attempt)].append(entity)
        for (kind, new), of in drawn.items():
            if (kind, new) not in taken and not (kind.startswith("given") and new in names):
                done[kind, min(of)] = new
                del todo[kind, min(of)]
        todo = {e: a + 1 for e, a in todo.items()}
    out = []
    for x, f in zip(texts, found):
        news = ["".join(lead + formatted(k, form, done.get((k, e)) or surrogate(k, e, 0)) for k, e, lead, form in parts(m)) for m in f]
        out.append((x if not f else "".join(a + b for a, b in zip(ANY.split(x), [*news, ""])), len(f)))
    return out


SURNAMES = [a + b for a in "BCDFGHKLMNPRSTVW" for b in "aeiou"]
TEXTS = [
    "Anna.Schmidt@Example.com anna.schmidt@example.com +1 (743) 555-3824 +17435553824 4111 1111 1111 1111 10.0.0.1 Mr. John Smith, Mrs. Clara Weiss",
    "see 10.0.0.1 and anna.schmidt@example.com, 123-45-6789, DE89 3704 0044 0532 0130 00 or DE89370400440532013000", None, "", "nothing", "Mrs. Alex Kim met Alex Kim and Mr. Kim",
    "Señora Petra Núñez, Frau Müller, Maria Núñez. Mr. Smith. Herr Иван Петров", *[f"Mr. {x}" for x in SURNAMES], *[f"to a{k % 37}@b.cd now" for k in range(60)],
]


def test_against_plain_version(spark):
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(TEXTS)], "doc_id long, text string")
    rows = {r.doc_id: (r.text, r["__n_entities"]) for r in pii.replace(docs, KEY).collect()}
    assert [rows[k] for k in range(len(TEXTS))] == plain(TEXTS)
    again = {r.doc_id: r.text for r in pii.replace(docs, "another key").collect()}
    assert all(again[k] != rows[k][0] for k in range(len(TEXTS)) if rows[k][1])


def test_saturated_formats_grow(spark):
    rows = spark.createDataFrame([(k, f"Mr. {x}") for k, x in enumerate(SURNAMES)], "doc_id long, text string")
    new = [r.text.removeprefix("Mr. ") for r in pii.replace(rows, KEY).collect()]
    assert len(set(new)) == len(SURNAMES) and not set(new) & set(SURNAMES) and all(x[0].isupper() for x in new)


def test_names_keep_family_and_gender(spark):
    texts = ["Mr. Smith", "John Smith", "Mrs. Maria Smith", "Maria Smith", "Mrs. Alex Kim", "Mr. Alex Kim", "Frau Zora Kim"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace(rows, KEY).collect()}
    smith, kim = out[0].removeprefix("Mr. "), out[4].split(" ")[-1]
    assert out[1].endswith(f" {smith}") and out[2] == f"Mrs. {out[3]}" and out[3].split(" ")[0] in pii.FEMALE and out[3].endswith(smith)
    assert out[1].split(" ")[0] in pii.MALE and out[1].split(" ")[0] != "John"
    assert out[4].split(" ")[1].endswith("a") and out[5].split(" ")[1] in pii.MALE and out[6].split(" ")[1].endswith("a") and out[6].endswith(kim)
    assert len(set(out.values())) == len(texts)


def test_long_texts_and_names(spark):
    name, dots = "B" + "abcdefghij" * 1000, "x@" + "a." * 500_000 + "com"
    texts = ["x " * 200_000 + f"Mr. {name} wrote", dots, f"{dots} anna@b.example.com", "q" * 1_000_000, "7" * 1_000_000, "Aa-" * 300_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace(rows, KEY).collect()}
    assert len(out[0]) == len(texts[0]) and name not in out[0]
    assert out[2].startswith(dots) and "anna@" not in out[2] and [out[k] for k in (1, 3, 4, 5)] == [texts[k] for k in (1, 3, 4, 5)]


def test_rows_columns_and_key(spark):
    rows = spark.createDataFrame([(1, "a@b.cd", 1), (1, "a@b.cd", 2), (1, "e@b.cd", 3), (None, "a@b.cd", 4), (2, None, 5)], "doc_id long, text string, tag int")
    df = rows.selectExpr("*", "7 doc", "8 row", "9 new", "'x' __n_entities", "5 gaps")
    out = pii.replace(df, KEY)
    got = {r.tag: r for r in out.collect()}
    assert out.columns == df.columns and len(got) == 5 and got[1].text == got[2].text == got[4].text != got[3].text and got[5].text is None
    assert {(r.doc, r.row, r.new, r.gaps) for r in got.values()} == {(7, 8, 9, 5)} and [got[k]["__n_entities"] for k in (1, 5)] == [1, 0]
    assert pii.replace(rows.limit(0), KEY).count() == 0
    with pytest.raises(ValueError):
        pii.replace(rows, "")
    assert pii.session_key(spark) == pii.session_key(spark)


def test_one_hash_for_all_letters(spark):
    df = spark.createDataFrame([("family", "smith", 0)], "kind string, entity string, attempt int")
    assert df.select(pii.surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), KEY)).first()[0] == surrogate("family", "smith", 0)
