"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

from .quality import ALPHA, DELTA, MAX_REPEAT, MIN_WORDS, RULES, SCALE, least_labels

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.line, k.pos, c.key IS NOT NULL AND k.doc_id <> c.top AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

#: Documents by part, the filters they fail and their labels, then every order of the five letters over those counts.
FILTER_AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(text, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
             len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
             100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, coalesce(least < w.doc_id, false) AS e
      FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, good, toxic, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT k1.name || k2.name || k3.name || k4.name || k5.name AS filter_order, [k1.bit, k2.bit, k3.bit, k4.bit, k5.bit] AS bits
      FROM k k1, k k2, k k3, k k4, k k5 WHERE k1.bit | k2.bit | k3.bit | k4.bit | k5.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step]) AS INT) - bits[step] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & bit > 0 AND good THEN n ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & before = 0 AND mask & bit > 0 AND toxic THEN n ELSE 0 END) AS toxic_lost
      FROM m, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

LEXICAL_SEARCH = f"""
WITH pattern AS (SELECT '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+' AS p),
t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), (SELECT p FROM pattern))) AS term FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), (SELECT p FROM pattern))) AS term FROM benchmark),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
p AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)) AS impact FROM tf JOIN d USING (doc_id), c),
a AS (SELECT item_id, term, count(*) * w AS w FROM q JOIN w USING (term) GROUP BY item_id, term, w),
s AS (SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score FROM a JOIN p USING (term) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


def quality_rules() -> str:
    share, level = ALPHA / len(RULES), f"({DELTA} / ({len(RULES)} * n_strata))"
    values = " UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, {r} AS value FROM g" for r in RULES)
    tail = (
        f"(SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share}))) "
        "FROM (SELECT unnest(range(0, over + 1)) AS i))"
    )
    cuts = ", ".join(f"min(value) FILTER (WHERE rule = '{r}' AND p <= {level}) AS cut_{r}" for r in RULES)
    failed = " OR ".join(["base_failed", *[f"coalesce({r} > cut_{r}, false)" for r in RULES]])
    return f"""
    WITH d AS (
      SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
             [x for x in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w,
             [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls
      FROM documents),
    win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
    rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1),
    cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) AS t(o) GROUP BY doc_id),
    f AS (
      SELECT d.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) AS upper, length(regexp_replace(text, '\\P{{L}}+', '', 'g')) AS letters
      FROM d LEFT JOIN cov USING (doc_id)),
    r AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
             coalesce({SCALE} * n_symbols // nullif(word_chars, 0), 0) AS symbol_share, coalesce({SCALE} * upper // nullif(letters, 0), 0) AS upper_share,
             coalesce({SCALE} * n_dup_lines // nullif(n_lines, 0), 0) AS line_share, coalesce({SCALE} * n_repeat_words // nullif(n_words, 0), 0) AS repeat_share
      FROM f),
    good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
    g AS (SELECT r.* FROM r JOIN good USING (doc_id) WHERE NOT base_failed),
    s AS (SELECT stratum, count(*) AS n FROM g GROUP BY stratum HAVING count(*) >= {least_labels()}),
    t AS (SELECT *, count(*) OVER () AS n_strata FROM s),
    v AS (SELECT stratum, rule, value, count(*) AS c FROM ({values}) GROUP BY ALL),
    o AS (SELECT stratum, rule, value, n, n_strata, CAST(coalesce(sum(c) OVER (PARTITION BY stratum, rule ORDER BY value DESC
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS over FROM v JOIN t USING (stratum)),
    p AS (SELECT *, {tail} AS p FROM o WHERE over <= n * {share}),
    c AS (SELECT stratum, {cuts} FROM p GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT ({failed}) AS kept
    FROM r LEFT JOIN c USING (stratum)
    """
