"""Operator 3: surrogates for personal data.

Entities found by pattern (mail, address, account, number, phone, card, person) are replaced by keyed
surrogates of the same type and format: digits stay digits, letters keep case and script, vowels stay vowels,
separators stay where they are, given names keep their gender, cards that pass the Luhn test still do. One
entity, in its canonical form, has one surrogate in all documents (coreference); two never share one and none
is an entity of the corpus itself (distinctness): each round, of the entities that clash, all but the first
draw again. Where a format is nearly full, draws after GROW rounds are a character longer each, so every draw ends.

A person's given and family name are entities of their own, so a title with a family name, and given and family
name, keep the family's surrogate in common. A title decides on the gender, or else the given name. Listed given names are
exchanged for one another by a keyed cycle through the names of their gender; others, after a title, get made-up
names with a feminine or masculine end.

The key must be given; whoever knows it can test guesses. It stands in query plans as a literal, so a cluster
that keeps event logs should set spark.sql.redaction.string.regex.

Everything is DataFrame and SQL functions; texts without entities are passed through untouched, and only texts
with entities are shuffled. Null and empty texts and texts without entities stay as they are. Repeated rows
stay, equally replaced; rows of one id keep their own texts; a null id is one like any other. Where two patterns start at one place, the kind
listed first wins. An empty table gives none. Texts of any length are searched whole: no pattern recurses
without bound. Other columns, whatever their names, are carried along untouched.
"""

from __future__ import annotations

import hashlib
from secrets import token_hex

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, columns_of, let, whole_row

#: Where a session holds the key; the name makes Spark redact it in lists of settings.
KEY_SETTING = "spark.foliant.pii.secret"
#: Draws of the entity's own length before they grow.
GROW = 4
#: Given names by gender, in order; surrogate names come from the same list. Fixed values.
FEMALE = "Alice Anna Carmen Charlotte Clara Elena Emma Eva Greta Hannah Helene Ines Isabel Julia Laura Lena Lucia Maria Marta Nina Nora Olivia Paula Sara Sofia Teresa".split()
MALE = "Adam Alex Andreas Antonio Carlos Daniel David Diego Emil Felix Hugo Ivan Jakob James Jean John Jorge Karl Lukas Marco Martin Michael Paul Peter Robert Thomas".split()
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Doña".split(), "m": "Mr Herr Monsieur Señor Don".split()}
_NAME = r"\p{Lu}[\p{Ll}'’-]+"
_SEP = r"[\x20./-]"
_FRENCH = r"0[1-9](?:[\x20.-]\d{2}){4}"
_GERMAN = r"(?!(?:\d{4}[\x20-]){3}\d)0[1-9]\d{1,4}[\x20/-](?:\d{6,8}|\d{2,5}(?:[\x20-]\d{2,6}){1,3}|\d{4,5})"
_NEXT = rf"(?:\d{{4}}[\x20-]){{3}}\d|\d{{4}}[\x20-]\d{{6}}[\x20-]\d{{5}}|\d{{3}}-\d{{2}}-\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}|{_FRENCH}|{_GERMAN}"


def _behind(least: int, most: int, end: str = "") -> str:
    """After a plus with so many digits and their separators, then end; written out, as Java bounds no repeated group here."""
    one, more = r"[\x20./()-]{0,2}\d", ""
    for _ in range(most - least):
        more = rf"(?:{one}{more})?"
    return rf"(?<=\+{one * least}{more}{end})"


#: A further group; none after a space that begins a dotted address, nor, after 7 digits, a card or another number.
_GROUP = rf"(?:[./-]\d{{1,8}}|\x20(?!(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?!\d|\.\d))(?!{_behind(7, 14, ' ')}(?:{_NEXT}))\d{{1,8}})"
#: +1 and +33 in their own grouping, other codes with groups of 1 to 8 digits, 7 to 15 digits in all; national forms.
_PHONE = "|".join(
    [
        rf"(?=\+)(?<![\w+])(?:\+\d{{7,15}}|\+1{_SEP}?\d{{3}}{_SEP}?\d{{3}}{_SEP}?\d{{4}}|\+\d{{1,3}}{_SEP}?\(\d{{3}}\){_SEP}?\d{{3}}{_SEP}?\d{{4}}|\+33{_SEP}?(?:\(0\)\x20?)?\d(?:{_SEP}?\d{{2}}){{4}}"
        rf"|\+\d{{1,3}}{_SEP}?\(\d{{1,4}}\){_SEP}?\d{{1,8}}{_GROUP}{{0,5}}{_behind(7, 15)}|\+\d{{1,6}}{_GROUP}{{1,6}}{_behind(7, 15)})(?!\d)",
        r"(?=\()(?<![\w(])\(\d{3}\)\x20?\d{3}-\d{4}(?!\d)",
        r"(?=\d)(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
        r"(?=\d)(?<![\w.])\d{3}\.\d{3}\.\d{4}(?!\w|\.\d)",
        rf"(?=0)(?<![\w+]|\d[.,/-])(?:{_FRENCH}|{_GERMAN})(?!\w|[.,/-]\d)",
    ]
)
#: kind: pattern; earlier kinds win where two could start at one place. Fixed values.
PATTERNS = {
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,125}\.\p{L}{2,}",  # a domain has 127 labels at most
    "address": r"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "account": r"(?=[A-Z])(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "number": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": _PHONE,
    "card": r"(?=\d)(?<![A-Za-z0-9])\d(?:[\x20-]?\d){12,18}(?![A-Za-z0-9]|\.\d)",
    "person": rf"(?=\p{{Lu}})\b(?:{'|'.join(TITLES['f'] + TITLES['m'])})\.?\x20{_NAME}(?:\x20{_NAME})?|(?=\p{{Lu}})\b(?:{'|'.join(FEMALE + MALE)})\x20{_NAME}",
}
ANY = "|".join(PATTERNS.values())
_TITLE = rf"^((?:{'|'.join(TITLES['f'] + TITLES['m'])})\.?\x20)"


def session_key(spark: SparkSession) -> str:
    """The key in the session's settings; one drawn at random, and kept there, where there is none."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, token_hex(32))
    return spark.conf.get(KEY_SETTING)


def has_entity(text: Column) -> Column:
    """Whether any pattern matches; all but person need a digit or an @, which is quick to rule out."""
    return F.when(text.contains("@") | text.rlike(r"\d"), text.rlike(ANY)).otherwise(text.rlike(PATTERNS["person"]))


def kind_of(entity: Column) -> Column:
    out = None
    for kind, pattern in PATTERNS.items():
        test = entity.rlike(f"^(?:{pattern})$")
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("person")


def canonical(kind: Column, entity: Column) -> Column:
    """What mentions of one entity share: digits of numbers, the rest without case or spaces between groups."""
    return F.when(kind.isin("number", "phone", "card"), F.regexp_replace(entity, r"\D", "")).when(kind == "account", F.regexp_replace(entity, " ", "")).otherwise(F.lower(entity))


def parts(kind: Column, mention: Column) -> Column:
    """array of (kind, entity, lead, form): what is replaced in a mention, with the text before each part that stays.

    A person is a given name, if there is one, of kind listed_f, listed_m, given_f or given_m, and a family.
    """
    one = lambda k, form, lead: F.struct(k.alias("kind"), canonical(k, form).alias("entity"), lead.alias("lead"), form.alias("form"))

    def person(names):
        title = F.regexp_extract(mention, _TITLE, 1)
        bare = F.regexp_replace(title, r"\.?\x20$", "")
        given = F.get(names, F.lit(0))
        listed = {sex: F.lower(given).isin([n.lower() for n in of]) for sex, of in (("f", FEMALE), ("m", MALE))}
        female = F.when(title != "", bare.isin(TITLES["f"])).otherwise(listed["f"])
        sort = F.when(female, F.when(listed["f"], "listed_f").otherwise("given_f")).otherwise(F.when(listed["m"], "listed_m").otherwise("given_m"))
        two, family = F.size(names) > 1, F.element_at(names, -1)
        return F.when(two, F.array(one(sort, given, title), one(F.lit("family"), family, F.lit(" ")))).otherwise(F.array(one(F.lit("family"), family, title)))

    return F.when(kind == "person", let(F.split(F.regexp_replace(mention, _TITLE, ""), " "), person)).otherwise(F.array(one(kind, mention, F.lit(""))))


def _hash(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string")), 512)


def _byte(h: Column, i: Column) -> Column:
    """A number below 65536 of the i-th place of a hash."""
    return F.conv(F.substring(h, i % 125 + 1, F.lit(4)), 16, 10).cast("int")


def _letters(alphabet: str, h: Column, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _byte(h, i) % len(alphabet) + 1, F.lit(1))


#: Letters that stand for letters of the same script, case and sound class. Fixed values.
CLASSES = [
    ("[aeiouyáàâäéèêëíìîïóòôöúùûü]", "aeiou"), ("[AEIOUYÁÀÂÄÉÈÊËÍÌÎÏÓÒÔÖÚÙÛÜ]", "AEIOU"),
    (r"[\p{IsLatin}&&\p{Ll}]", "bcdfghklmnprstvwz"), (r"[\p{IsLatin}&&\p{Lu}]", "BCDFGHKLMNPRSTVWZ"),
    (r"[\p{IsCyrillic}&&\p{Ll}]", "абвгдеиклмнопрстуя"), (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕИКЛМНОПРСТУЯ"),
    (r"[\p{IsGreek}&&\p{Ll}]", "αβγδεηικλμνοπρτυω"), (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΗΙΚΛΜΝΟΠΡΤΥΩ"),
    (r"\d", "0123456789"),
]


def _shape(text: Column, h: Column) -> Column:
    """Every letter and digit of text replaced by one of its class, by its place in the text."""

    def one(c, i):
        alphabet = None
        for pattern, letters in CLASSES:
            alphabet = F.when(c.rlike(pattern), letters) if alphabet is None else alphabet.when(c.rlike(pattern), letters)
        drawn = let(alphabet, lambda a: F.substring(a, _byte(h, i) % F.length(a) + 1, F.lit(1)))
        return F.coalesce(drawn, c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _spread(digits: Column, form: Column) -> Column:
    """digits put in the places of the digits of form; those beyond follow at the end."""
    step = lambda a, c: F.struct(
        F.concat(a["out"], F.when(c.rlike(r"\d"), F.substring(digits, a["n"] + 1, F.lit(1))).otherwise(c)).alias("out"), (a["n"] + F.when(c.rlike(r"\d"), 1).otherwise(0)).alias("n")
    )
    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda a: F.concat(a["out"], F.substring(digits, a["n"] + 1, F.length(digits))))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits modulo 10, doubling every second digit from the right, the last one not."""

    def one(c, i):
        d = F.when(c.rlike(r"\d"), c.cast("int")).otherwise(0) * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, d: a + d) % 10


#: Letters that lengthen a name and ends of made-up given names, by script. Fixed values.
LONGER = [(r"^\p{IsCyrillic}", "аеиолнрст"), (r"^\p{IsGreek}", "αειολνρστ"), ("", "aeiolnrst")]
ENDS = {"f": [(r"^\p{IsCyrillic}", "а"), (r"^\p{IsGreek}", "α"), ("", "a")], "m": [(r"^\p{IsCyrillic}", "н"), (r"^\p{IsGreek}", "ς"), ("", "n")]}


def _by_script(entity: Column, choices: list, make) -> Column:
    out = None
    for pattern, value in choices:
        test, new = entity.rlike(pattern), make(value)
        out = F.when(test, new) if out is None else out.when(test, new)
    return out


def cycle(names: list[str], key: str) -> dict[str, str]:
    """Each name with the next of a keyed order: no name stays itself, and no two become one."""
    order = sorted([n.lower() for n in names], key=lambda n: hashlib.sha256(f"{key}\x1f{n}".encode()).hexdigest())
    return dict(zip(order, order[1:] + order[:1]))


def surrogate(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity in canonical form, itself in canonical form."""
    last = lambda x: F.substring(x, F.lit(1), F.length(x) - 1)
    exchange = {sex: F.create_map(*[F.lit(x) for pair in cycle(names, key).items() for x in pair]) for sex, names in (("f", FEMALE), ("m", MALE))}

    def drawn(h, shaped):
        extra = F.greatest(attempt - (GROW - 1), F.lit(0))

        def longer(alphabet, by=0):
            return F.when(extra > 0, F.array_join(F.transform(F.sequence(F.lit(1), extra + by), lambda k: _letters(alphabet, h, k * 3 + 60)), "")).otherwise("")

        digits = longer("0123456789")
        letters = _by_script(entity, LONGER, longer)
        kept = lambda n: F.concat(F.left(entity, F.lit(n)), F.substring(shaped, F.lit(n + 1), F.length(entity)), digits)
        card = F.when(_luhn(entity) == 0, let(last(kept(1)), lambda x: F.concat(x, ((10 - _luhn(F.concat(x, F.lit("0")))) % 10).cast("string")))).otherwise(kept(1))
        octet = lambda i, low, n: (_byte(h, F.lit(4 * i)) % n + low).cast("string")
        port = F.when(extra > 0, F.concat(F.lit(":"), longer("123456789", 3))).otherwise("")
        address = F.concat(F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254)), port)
        tail = F.concat(F.lit("."), F.substring_index(entity, ".", -1))
        mail = F.concat(longer("aeiolnrst"), F.left(shaped, F.length(entity) - F.length(tail)), tail)
        end = F.when(kind == "given_f", _by_script(entity, ENDS["f"], F.lit)).otherwise(_by_script(entity, ENDS["m"], F.lit))
        return (
            F.when(kind == "mail", mail).when(kind == "address", address).when(kind == "account", kept(2)).when(kind == "card", card).when(kind == "phone", kept(1))
            .when(kind == "number", F.concat(shaped, digits)).when(kind.isin("given_f", "given_m"), F.concat(last(shaped), letters, end)).otherwise(F.concat(shaped, letters))
        )

    # The hash and the shape are bound once, which also keeps the plan small.
    made = let(_hash(kind, entity, attempt, key), lambda h: let(_shape(entity, h), lambda shaped: drawn(h, shaped)))
    return F.when(kind == "listed_f", F.element_at(exchange["f"], entity)).when(kind == "listed_m", F.element_at(exchange["m"], entity)).otherwise(made)


def formatted(kind: Column, form: Column, new: Column) -> Column:
    """A surrogate in the form of what it replaces: its separators, its capitals."""
    name = F.concat(F.upper(F.left(new, F.lit(1))), F.substring(new, F.lit(2), F.length(new)))

    def cased(c, i):
        return F.when(F.substring(form, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)

    mail = F.when(form == F.lower(form), new).otherwise(F.array_join(F.transform(F.split(new, ""), cased), ""))
    groups = F.when(F.contains(form, F.lit(" ")), F.trim(F.regexp_replace(new, "(.{4})", "$1 "))).otherwise(new)
    return (
        F.when(kind.isin("number", "phone", "card"), _spread(new, form)).when(kind == "mail", mail).when(kind == "account", groups)
        .when(kind == "address", new).otherwise(name)
    )


def _mentions(texts: DataFrame) -> DataFrame:
    """doc, tag, i, j, last, kind, entity, lead, form of every part j of every mention i; rows that are the same text of the same id are one."""
    found = texts.where(has_entity(F.col("text"))).select("doc", "tag", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found")).where(F.size("found") > 0)
    each = found.select("doc", "tag", F.posexplode("found").alias("i", "mention"))
    each = each.select("doc", "tag", "i", parts(kind_of(F.col("mention")), F.col("mention")).alias("parts"))
    return each.select("doc", "tag", "i", F.size("parts").alias("n"), F.posexplode("parts").alias("j", "p")).select("doc", "tag", "i", "j", (F.col("j") == F.col("n") - 1).alias("last"), "p.*")


def assign(entities: DataFrame, scratch: Scratch, key: str) -> DataFrame:
    """kind, entity, attempt, new of distinct (kind, entity) rows, with no new twice and none that is an entity.

    Rounds are written down one after the other; only those that clash draw again, against all that is taken.
    Kinds listed_f and listed_m, whose exchange is one to one, are left out.
    """
    tasks = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    names = [n.lower() for n in FEMALE + MALE]
    entities = scratch.write(entities.where(~F.col("kind").isin("listed_f", "listed_m")).repartition(tasks, "kind", "entity"), "entities")
    everyone = entities.select("kind", F.col("entity").alias("new"))
    todo, taken, done, round_ = entities.withColumn("attempt", F.lit(0)), everyone, None, 0
    while True:
        drawn = todo.withColumn("new", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key))
        free = drawn.join(taken.withColumn("used", F.lit(True)), ["kind", "new"], "left")
        first = F.row_number().over(Window.partitionBy("kind", "new").orderBy("entity"))
        listed = F.col("kind").isin("given_f", "given_m") & F.col("new").isin(names)
        ranked = scratch.write(free.withColumn("ok", F.col("used").isNull() & ~listed & (first == 1)).select("kind", "entity", "attempt", "new", "ok"), f"round{round_}")
        won = ranked.where("ok").drop("ok")
        done = won if done is None else done.unionByName(won)
        lost = ranked.where("not ok")
        if lost.isEmpty():
            return done
        taken = everyone.unionByName(done.select("kind", "new"))
        todo, round_ = lost.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), round_ + 1


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with surrogates in text_col, and the number of mentions as __n_entities besides (a column of that name is replaced)."""
    if not key:
        raise ValueError("surrogates need a key")
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("tag"))
    mentions = scratch.write(_mentions(keyed.select("doc", "tag", "text")).distinct(), "mentions")
    named = assign(mentions.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n")).drop("n"), scratch, key)
    # First draws need no lookup; only the entities that drew again are joined to the mentions.
    again = scratch.write(named.where("attempt > 0").select("kind", "entity", F.col("attempt").alias("later")), "again")
    tried = mentions.join(again, ["kind", "entity"], "left").withColumn("attempt", F.coalesce("later", F.lit(0)))
    new = surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key)
    piece = F.concat("lead", formatted(F.col("kind"), F.col("form"), new))
    said = tried.select("doc", "tag", F.struct("i", "j", "last", piece.alias("new")).alias("s"))
    by = scratch.write(said.groupBy("doc", "tag").agg(F.array_sort(F.collect_list("s")).alias("new")), "new")
    scratch.drop("mentions", "entities", "again")
    has = has_entity(F.col("text"))
    # An id may be null, so the join is by its hash and the text's.
    same = lambda df: df.withColumn("id", F.xxhash64("doc"))
    joined = same(keyed.where(has)).join(same(by).select("id", "tag", "new"), ["id", "tag"], "left").withColumn("gaps", F.split("text", ANY, -1))
    after = lambda s: F.when(s["last"], F.get("gaps", s["i"] + 1)).otherwise("")
    put = F.concat(F.get("gaps", F.lit(0)), F.array_join(F.transform("new", lambda s: F.concat(s["new"], after(s))), ""))
    n = F.size(F.filter("new", lambda s: s["last"])).cast("long")
    out = joined.select(*columns_of(docs, **{text_col: put, "__n_entities": n}))
    rest = keyed.where(~has).select(*columns_of(docs, __n_entities=F.lit(0).cast("long")))
    return out.unionByName(rest)
