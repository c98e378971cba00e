"""Title case and country codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Small words that stay lower-case inside a title.
SMALL = ("a", "an", "and", "as", "at", "but", "by", "en", "for", "if", "in", "nor", "of", "on", "or", "the", "to", "v", "via", "vs")
#: Names of countries as the ranking file spells them where they differ from the standard's.
COUNTRY_OVERRIDES = {
    "United States": "US", "United Kingdom": "GB", "South Korea": "KR", "Czech Republic": "CZ", "Russian Federation": "RU", "Iran": "IR", "Vietnam": "VN",
    "Taiwan": "TW", "Moldova": "MD", "Syrian Arab Republic": "SY", "Venezuela": "VE", "Bolivia": "BO", "Tanzania": "TZ", "Laos": "LA", "North Korea": "KP",
    "Brunei Darussalam": "BN", "Cote d'Ivoire": "CI", "Ivory Coast": "CI", "Palestine": "PS", "Reunion": "RE", "Macau": "MO",
}


def title_case(s: Column) -> Column:
    """words with a capital first, small words lower-case unless first, last or after a colon.

    A text in capitals throughout is lowered first; words that mix cases or hold a stop inside keep their form, and so do joined ones that hold a
    capital after a letter, such as BY-NC. Of other words joined by a hyphen or stroke each is a word, the small ones lower-case. After o' and the like, and after Mc, the next letter is a capital, and
    d' and l' are small.
    """
    shout = (s == F.upper(s)) & (s != F.lower(s))
    split = F.split(F.when(shout, F.lower(s)).otherwise(s), " ", -1)

    def capital(w):
        # Most words begin with their first letter, and with no name's prefix.
        plain = w.rlike(r"^(?![dolDOL]['‘’]\p{Ll}|[Mm]c\p{Ll}\p{L})\p{L}")
        return F.when(plain, F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))).otherwise(capital_inside(w))

    def capital_inside(w):
        first = F.regexp_extract(w, r"^[^\p{L}]*", 0)
        rest = F.substr(w, F.length(first) + 1)
        upper = lambda at: F.concat(F.upper(F.left(F.substr(rest, F.lit(at)), F.lit(1))), F.substr(rest, F.lit(at + 1)))
        head = F.left(rest, F.lit(1))
        vowel = F.lower(head).isin("a", "e", "i", "o", "u")
        joined = F.concat(first, F.when(vowel, F.upper(head)).otherwise(F.lower(head)), F.substr(rest, F.lit(2), F.lit(1)), upper(3))
        return F.when(rest.rlike(r"^[dolDOL]['‘’]\p{Ll}+"), joined).when(rest.rlike(r"^[Mm]c\p{Ll}\p{L}+"), F.concat(first, F.lit("Mc"), upper(3))).otherwise(F.concat(first, upper(1)))

    def small(w):
        few = w.rlike(r"^[^\p{L}]*(?:\p{L}[^\p{L}]*){1,3}$")  # as many letters as the longest has
        return few & F.lower(F.regexp_replace(w, r"[^\p{L}]", "")).isin(*SMALL)

    def parts(w, mark, edge):
        each = F.transform(F.split(w, mark, -1), lambda p, i: F.when(small(p) & ~(edge & (i == 0)), F.lower(p)).otherwise(capital(p)))
        return F.array_join(each, mark)

    def one(words, w, i):
        inner = (i > 0) & (i < F.size(words) - 1) & ~F.coalesce(F.get(words, i - 1).endswith(":"), F.lit(False))
        own = w.rlike(r"\p{Ll}.*\p{Lu}|\p{L}\.\p{L}")
        joined = w.rlike(r"\p{L}[-/]\p{L}")
        own |= joined & w.rlike(r"\p{L}\p{Lu}")
        by_part = F.when(w.contains("-"), parts(w, "-", ~inner)).otherwise(parts(w, "/", ~inner))
        return F.when(own, w).when(joined, by_part).when(inner & small(w), F.lower(w)).otherwise(capital(w))

    # An array of the one array, so that a long text is split once, not anew for each word.
    return F.array_join(F.get(F.transform(F.array(split), lambda words: F.transform(words, lambda w, i: one(words, w, i))), F.lit(0)), " ")


def country_codes(rows: DataFrame, name: str, codes: DataFrame | None = None, misspelt: bool = False) -> DataFrame:
    """rows with country_code: by the overrides, else by codes (name, code), a table of the standard's names, else, where misspelt, by the closest of those.

    Names are compared without case and outer blanks. Without codes, or for a name in neither, the code is NULL.
    """
    key = F.lower(F.trim(F.col(name)))
    known = F.create_map(*[F.lit(x) for k, v in COUNTRY_OVERRIDES.items() for x in (k.lower(), v)])
    if codes is None:
        return rows.withColumn("country_code", F.try_element_at(known, key))
    table = codes.groupBy(F.lower(F.trim("name")).alias("__name")).agg(F.min("code").alias("__code"))
    joined = rows.join(table, key == F.col("__name"), "left")
    coded = joined.withColumn("country_code", F.coalesce(F.try_element_at(known, key), "__code")).drop("__name", "__code")
    if not misspelt:
        return coded
    open_ = coded.where(F.col("country_code").isNull() & F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    near = closest_names(open_, codes.select(F.col("name").alias("match"))).join(codes.groupBy(F.col("name").alias("match")).agg(F.min("code").alias("__near")), "match")
    near = near.select(F.col("name").alias("__name"), "__near")
    return coded.join(near, F.col(name) == F.col("__name"), "left").withColumn("country_code", F.coalesce("country_code", "__near")).drop("__name", "__near")


def allowed_edits(letters: Column) -> Column:
    """How many letters of a name of so many may be wrong: none below four, one below eight, two from there on."""
    return F.when(letters < 4, 0).when(letters < 8, 1).otherwise(2)


def closest_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """name, match, edits of each of names (name) that is within allowed_edits() of one of known (match); the closest counts, then the first by letters.

    A known name is cut into one piece more than edits are allowed: one piece at least stands unchanged in any name within
    reach, moved by no more places than that. Names meet known ones by length, piece and letters in one equi-join, so no pair that is
    within reach is lost, and none is compared that shares nothing. Equal names are matches of no edits; case is ignored.
    The pieces of names, some sixty of each, pass into the join as they come; only the pairs that it leaves are told apart.
    """
    key = lambda c: F.lower(F.trim(F.col(c)))
    piece = lambda n, d, i: F.floor(n * i / (d + 1)).cast("int")
    cut = known.select("match", key("match").alias("k")).where("k <> ''").distinct().withColumns({"n": F.length("k"), "d": allowed_edits(F.length("k"))})
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    start, end = piece(F.col("n"), F.col("d"), F.col("i")), piece(F.col("n"), F.col("d"), F.col("i") + 1)
    cut = cut.select("match", "k", "d", "n", "i", F.substring("k", start + 1, end - start).alias("letters"))
    mine = names.select("name", key("name").alias("q")).where("q <> ''").distinct()
    mine = mine.withColumn("n", F.explode(F.sequence(F.greatest(F.length("q") - 2, F.lit(1)), F.length("q") + 2)))
    mine = mine.withColumn("d", allowed_edits(F.col("n"))).where(F.abs(F.length("q") - F.col("n")) <= F.col("d"))
    mine = mine.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d")))).withColumn("shift", F.explode(F.sequence(-F.col("d"), F.col("d"))))
    start, end = piece(F.col("n"), F.col("d"), F.col("i")), piece(F.col("n"), F.col("d"), F.col("i") + 1)
    mine = mine.select("name", "q", "n", "i", F.substring("q", start + F.col("shift") + 1, end - start).alias("letters"), (start + F.col("shift")).alias("at")).where("at >= 0").drop("at")
    pairs = mine.join(cut, ["n", "i", "letters"]).select("name", "q", "match", "k", "d").distinct()
    near = pairs.withColumn("edits", F.levenshtein("q", "k", 2)).where("edits between 0 and d")
    best = near.groupBy("name").agg(F.min(F.struct("edits", "match")).alias("b"))
    return best.select("name", F.col("b.match").alias("match"), F.col("b.edits").alias("edits"))
