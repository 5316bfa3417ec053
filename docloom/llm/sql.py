"""Longer DuckDB SQL of registered queries, on whole tables."""

from __future__ import annotations

from docloom.llm import licenses, quality

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def near_groups(words: int = 4) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS g FROM d),
u AS (SELECT doc_id, unnest(g) AS x FROM s),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, t.b FROM r JOIN both_ways t ON r.b = t.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""


def license_scan() -> str:
    quote = lambda items: ", ".join("'" + x + "'" for x in items)
    token = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrase = lambda p: f"len(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(p) - 1}] = [{quote(p)}]))"
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(p.split()) - 1}] = [{quote(p.split())}])) - 1 AS pos FROM d"
        for p, label in licenses.PHRASES.items())
    hits, rows = [], []
    for k, (label, found) in enumerate(licenses.template_words()):
        if len(found) < licenses.ORDERED:
            rows.append(f"SELECT doc_id, '{label}' AS label, CAST(1 AS DOUBLE) AS c FROM d WHERE {phrase(found)} > 0")
            continue
        n, tokens = len(set(found)), quote(sorted(set(found)))
        enough = f"{licenses.THRESHOLD} * {n} - 1e-9"
        # hits of the template in texts that hold enough of it at all; each opens a window of the template's length
        rows.append(f"""SELECT doc_id, '{label}' AS label, max(c) / CAST({n} AS DOUBLE) AS c FROM (SELECT a.doc_id, a.pos, count(DISTINCT b.x) AS c FROM h{k} AS a JOIN h{k} AS b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + {len(found)} GROUP BY a.doc_id, a.pos) GROUP BY doc_id HAVING max(c) >= {enough}""")
        hits.append(f"h{k} AS (SELECT doc_id, x, pos FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM d "
                    f"WHERE len(list_intersect(w, [{tokens}])) >= {enough}) WHERE x IN ({tokens}))")
    every, found = ",\n".join(hits), " UNION ALL ".join(rows)
    return f"""
WITH d AS (SELECT doc_id, {token.format(LOWER)} AS w FROM documents),
pl AS ({places}),
b AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM pl GROUP BY doc_id),
{every},
m AS ({found}),
f AS (SELECT doc_id, max(c) AS score, list(DISTINCT label) AS labels FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(f.score, 0.0) END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)"""


def quality_rules() -> str:
    value = {r: f"CAST(1.0 * {v[0]} AS DOUBLE)" for r, v in quality.RULES.items()}
    of = lambda k: "CASE rule " + " ".join(f"WHEN '{r}' THEN {float(v[k])}" for r, v in quality.RULES.items()) + " END"
    grow = f"(exp(bin * ln({quality.GROWTH})) - 1) / {quality.UNIT}"
    quantile = lambda q: f"min({grow}) FILTER (upto >= {q} * total)"
    reach = f"{quality.REACH} * (q75 - q25) + {of(1)}"

    def fences(level: int, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
i{level} AS (SELECT {by}rule, bin, top, bottom, sum(n) AS n FROM b JOIN ends USING (rule) WHERE {grow} <= top AND {grow} >= bottom GROUP BY ALL),
r{level} AS (SELECT *, sum(n) OVER (PARTITION BY {by}rule ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}rule) AS total FROM i{level}),
q{level} AS (SELECT {by}rule, top, bottom, {quantile(0.01)} AS q01, {quantile(0.5)} AS q50, {quantile(0.99)} AS q99, max(total) AS n_docs FROM r{level} GROUP BY ALL),
f{level} AS (SELECT {by}rule, max(n_docs) OVER (PARTITION BY {keys or '1'}) AS n_docs, least(top, q50 + {quality.TAIL} * (q99 - q50) + {of(2)}) AS high,
  CASE WHEN bottom < 0 THEN -1.0 ELSE greatest(bottom, q50 - {quality.TAIL} * (q50 - q01) - {of(2)}) END AS low FROM q{level})"""

    def drawn(end: str) -> str:
        share = lambda k: f"f{k}.n_docs / CAST(f{k}.n_docs + {quality.MIN_GROUP} AS DOUBLE)"
        lang = f"coalesce({share(1)} * f1.{end} + (1 - {share(1)}) * f0.{end}, f0.{end})"
        return f"coalesce({share(2)} * f2.{end} + (1 - {share(2)}) * {lang}, {lang})"

    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {WORDS.format('x')} AS w, list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS lines FROM t),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM w WHERE len(w) >= 3),
g AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w[pos], w[pos + 1], w[pos + 2]) AS n FROM p),
c AS (SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id),
m0 AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
m AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
vals AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, '{r}' AS rule, {v} AS x FROM m WHERE NOT base_failed" for r, v in value.items())}),
b AS (SELECT lang, source, rule, CAST(ceil(ln(1 + x * {quality.UNIT}) / ln({quality.GROWTH})) AS INT) AS bin, count(*) AS n FROM vals GROUP BY ALL),
bc AS (SELECT rule, bin, sum(n) AS n FROM b GROUP BY ALL),
rc AS (SELECT *, sum(n) OVER (PARTITION BY rule ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY rule) AS total FROM bc),
qc AS (SELECT rule, {quantile(0.25)} AS q25, {quantile(0.75)} AS q75 FROM rc GROUP BY rule),
ends AS (SELECT rule, q75 + {reach} AS top, CASE WHEN {of(3)} > 0 THEN q25 - ({reach}) ELSE -1.0 END AS bottom FROM qc),
{fences(2, 'lang, source')}, {fences(1, 'lang')}, {fences(0, '')},
judged AS (SELECT doc_id, bool_and(x <= {drawn('high')} AND x >= {drawn('low')}) AS passed
  FROM vals v LEFT JOIN f2 ON v.rule = f2.rule AND v.lang IS NOT DISTINCT FROM f2.lang AND v.source IS NOT DISTINCT FROM f2.source
  LEFT JOIN f1 ON v.rule = f1.rule AND v.lang IS NOT DISTINCT FROM f1.lang JOIN f0 ON v.rule = f0.rule GROUP BY doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(passed, false) AS kept
FROM m LEFT JOIN judged USING (doc_id)"""
