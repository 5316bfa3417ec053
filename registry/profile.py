"""Corpus profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import lexicon
from docloom.operators import profile as p
from registry.common import (SENTENCES, count_sql, docs, flags_sql, labelled, load, query, r, tidy, words_of)

L = {"label": "lang"}
FENCES = """
len AS (SELECT doc_id, lang, text, CAST(length(text) AS BIGINT) AS text_length FROM documents),
q AS (SELECT lang, quantile_cont(text_length, 0.25) AS q1, quantile_cont(text_length, 0.75) AS q3 FROM len GROUP BY lang),
f AS (SELECT lang, q1, q3, q3 - q1 AS iqr, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q),
o AS (SELECT len.* FROM len JOIN f USING (lang) WHERE text_length > upper_bound)"""


@query("ep01_length_stats", f"""
SELECT lang, count(*) AS count, {r('avg(length(text))', 2)} AS mean, {r('stddev_samp(length(text))', 2)} AS std,
  CAST(min(length(text)) AS BIGINT) AS min, CAST(max(length(text)) AS BIGINT) AS max,
  {r('quantile_cont(length(text), 0.25)', 2)} AS q1, {r('quantile_cont(length(text), 0.75)', 2)} AS q3
FROM documents GROUP BY lang""")
def _(spark, sf):
    return tidy(p.length_stats(docs(spark, sf), **L), 2)


@query("ep02_length_overview", f"""
SELECT {r('avg(length(text))', 4)} AS mean, {r('stddev_samp(length(text))', 4)} AS std FROM documents""")
def _(spark, sf):
    return tidy(p.length_overview(docs(spark, sf), **L), 4)


@query("ep03_zscore_outliers", f"""
WITH s AS (SELECT avg(length(text)) AS m, stddev_samp(length(text)) AS sd FROM documents)
SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS length, {r('(length(text) - m) / sd')} AS z
FROM documents, s WHERE abs((length(text) - m) / sd) > 3""")
def _(spark, sf):
    return tidy(p.zscore_outliers(docs(spark, sf), **L))


@query("ep04_outlier_summary", f"""
WITH {FENCES}
SELECT lang, {r('q1')} AS q1, {r('q3')} AS q3, {r('iqr')} AS iqr, {r('upper_bound')} AS upper_bound,
  count(*) AS total_samples, CAST(count(*) FILTER (text_length > upper_bound) AS BIGINT) AS num_outliers,
  {r('count(*) FILTER (text_length > upper_bound) * 100.0 / count(*)')} AS outlier_percentage,
  max(text_length) FILTER (text_length > upper_bound) AS max_length,
  min(text_length) FILTER (text_length > upper_bound) AS min_length
FROM len JOIN f USING (lang) GROUP BY lang, q1, q3, iqr, upper_bound""")
def _(spark, sf):
    return tidy(p.outlier_summary(docs(spark, sf), **L))


@query("ep05_longest_outliers", f"""
WITH {FENCES}
SELECT doc_id, lang, text_length, substr(text, 1, 100) AS preview,
  row_number() OVER (PARTITION BY lang ORDER BY text_length DESC, doc_id) AS rank
FROM o QUALIFY rank <= 3""")
def _(spark, sf):
    return tidy(p.longest_outliers(docs(spark, sf), **L))


@query("ep06_length_outliers", f"WITH {FENCES} SELECT doc_id, lang, text, text_length FROM o")
def _(spark, sf):
    return p.length_outliers(docs(spark, sf), **L)


@query("ep07_section_flags", f"SELECT doc_id, {flags_sql(lexicon.SECTION_RULES, 'lower(text)')} FROM documents")
def _(spark, sf):
    return tidy(p.section_flags(docs(spark, sf)))


STRUCTURE = f"""
CAST(len({SENTENCES}) AS BIGINT) AS num_sentences,
CAST(list_sum(list_transform({SENTENCES}, lambda s: len({words_of('s')}))) AS DOUBLE) / nullif(len({SENTENCES}), 0) AS avg_sentence_length,
CAST(len(string_split(text, chr(10) || chr(10))) AS BIGINT) AS num_paragraphs,
{flags_sql(lexicon.STRUCTURE_RULES, 'text')}"""


@query("ep08_content_structure", f"""
SELECT * REPLACE ({r('avg_sentence_length')} AS avg_sentence_length)
FROM (SELECT doc_id, {STRUCTURE} FROM documents)""")
def _(spark, sf):
    return tidy(p.content_structure(docs(spark, sf)))


@query("ep09_content_flags", f"SELECT doc_id, {flags_sql(lexicon.CONTENT_RULES, 'lower(text)')} FROM documents")
def _(spark, sf):
    return tidy(p.content_flags(docs(spark, sf)))


def _outlier_patterns_sql() -> str:
    shares = [(a, n) for a, rules in (("section", lexicon.SECTION_RULES), ("content", lexicon.CONTENT_RULES)) for n in rules]
    rows = [f"SELECT lang, '{a}' AS aspect, '{n}' AS name, avg({n}) * 100 AS value FROM w GROUP BY lang" for a, n in shares]
    rows += [f"SELECT lang, 'structure', '{n}', {e} FROM w GROUP BY lang" for n, e in
             (("avg_sentences", "avg(num_sentences)"), ("avg_sentence_length", "avg(avg_sentence_length)"),
              ("list_presence", "avg(has_lists) * 100"))]
    return f"""
WITH {FENCES}, w AS (SELECT lang, {flags_sql(lexicon.SECTION_RULES, 'lower(text)')},
  {flags_sql(lexicon.CONTENT_RULES, 'lower(text)')}, {STRUCTURE} FROM o),
v AS ({' UNION ALL '.join(rows)}), v2 AS (SELECT lang, aspect, name, {r('value')} AS value FROM v)
SELECT *, row_number() OVER (PARTITION BY lang, aspect ORDER BY value DESC, name) AS rank FROM v2"""


@query("ep10_outlier_patterns", _outlier_patterns_sql())
def _(spark, sf):
    return tidy(p.outlier_patterns(docs(spark, sf), **L))


@query("ep11_class_distribution", f"""
SELECT lang, count(*) AS count, {r('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS percentage
FROM documents GROUP BY lang""")
def _(spark, sf):
    return tidy(p.class_distribution(docs(spark, sf), "lang"), 2)


@query("ep12_distribution_stats", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
a AS (SELECT * FROM c ORDER BY n DESC, lang LIMIT 1), b AS (SELECT * FROM c ORDER BY n, lang LIMIT 1)
SELECT CAST((SELECT sum(n) FROM c) AS BIGINT) AS total_samples, (SELECT count(*) FROM c) AS num_classes,
  a.lang AS largest_class, a.n AS largest_class_count, b.lang AS smallest_class, b.n AS smallest_class_count,
  {r('a.n / CAST(b.n AS DOUBLE)')} AS imbalance_ratio FROM a, b""")
def _(spark, sf):
    return tidy(p.distribution_stats(docs(spark, sf), "lang"))


@query("ep13_cumulative_distribution", f"""
WITH c AS (SELECT source, count(*) AS count FROM documents GROUP BY source)
SELECT source, count, {r('sum(count) OVER (ORDER BY count DESC, source ROWS UNBOUNDED PRECEDING) * 100.0 / sum(count) OVER ()')}
  AS cumulative_percentage FROM c""")
def _(spark, sf):
    return tidy(p.cumulative_distribution(docs(spark, sf), "source"))


LABELLED = "(SELECT d.doc_id, d.text, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
COLUMNS = ["doc_id", "text", "lang", "quality", "toxic"]


def _missing_sql() -> str:
    cols = [f"SELECT '{c}' AS \"column\", count(*) AS cells, CAST(count_if({c} IS NULL) AS BIGINT) AS missing FROM {LABELLED}"
            for c in COLUMNS]
    union = " UNION ALL ".join(cols)
    return f"""WITH c AS ({union}), a AS (SELECT * FROM c UNION ALL
  SELECT '*', CAST(sum(cells) AS BIGINT), CAST(sum(missing) AS BIGINT) FROM c)
  SELECT "column", cells, missing, {r('missing * 100.0 / cells')} AS missing_percentage FROM a"""


@query("ep14_missing_by_column", _missing_sql())
def _(spark, sf):
    return tidy(p.missing_by_column(labelled(spark, sf).select(*COLUMNS)))


@query("ep15_blank_strings", """
WITH d AS (SELECT text, lang, regexp_extract(text, '[.]([^.]*)$', 1) AS tail FROM documents),
c AS (SELECT 'text' AS "column", text AS v FROM d UNION ALL SELECT 'lang', lang FROM d UNION ALL SELECT 'tail', tail FROM d)
SELECT "column", CAST(count_if(v = '') AS BIGINT) AS empty_strings,
  CAST(count_if(regexp_matches(v, '^\\s+$')) AS BIGINT) AS whitespace_only FROM c GROUP BY 1""")
def _(spark, sf):
    d = docs(spark, sf).select("text", "lang", F.regexp_extract("text", r"[.]([^.]*)$", 1).alias("tail"))
    return tidy(p.blank_strings(d))


@query("ep16_missing_by_class", " UNION ALL ".join(
    f"SELECT lang, '{c}' AS \"column\", count(*) AS total_samples, CAST(count_if({c} IS NULL) AS BIGINT) AS missing, "
    f"{r(f'count_if({c} IS NULL) * 100.0 / count(*)')} AS missing_percentage FROM {LABELLED} GROUP BY lang"
    for c in ("text", "quality", "toxic")))
def _(spark, sf):
    return tidy(p.missing_by_class(labelled(spark, sf), ["text", "quality", "toxic"], "lang"))


@query("ep17_length_checks", f"""
SELECT CAST(min(length(text)) AS BIGINT) AS min_length, CAST(max(length(text)) AS BIGINT) AS max_length,
  {r('avg(length(text))')} AS mean_length, CAST(count_if(length(text) = 0) AS BIGINT) AS zero_length,
  CAST(count_if(length(text) < 50) AS BIGINT) AS very_short FROM documents""")
def _(spark, sf):
    return tidy(p.length_checks(docs(spark, sf)))


@query("ep18_issue_counts", r"""
SELECT CAST(count_if(regexp_matches(text, '[^\p{L}\p{N}_\s.,;:\-()]')) AS BIGINT) AS invalid_chars,
  CAST(count_if(regexp_matches(text, '\s{2,}')) AS BIGINT) AS multiple_spaces,
  CAST(count_if(regexp_matches(text, '[^\x00-\x7F]')) AS BIGINT) AS special_chars FROM documents""")
def _(spark, sf):
    return tidy(p.issue_counts(docs(spark, sf)))


@query("ep19_duplicate_counts", """
SELECT CAST(count(*) - count(DISTINCT (text, lang)) AS BIGINT) AS exact_duplicates,
  CAST(count(*) - count(DISTINCT text) AS BIGINT) AS description_duplicates FROM documents""")
def _(spark, sf):
    return tidy(p.duplicate_counts(docs(spark, sf), ["text", "lang"]))


@query("ep19_duplicate_rows", """
SELECT doc_id, min(doc_id) OVER w AS first_id, count(*) OVER w AS copies FROM documents
WINDOW w AS (PARTITION BY text) QUALIFY doc_id > first_id""")
def _(spark, sf):
    return tidy(p.duplicate_rows(docs(spark, sf)))


CH = r"(SELECT lang, unnest(regexp_extract_all(text, '[^a-zA-Z0-9\s]')) AS ch FROM documents)"
PAGE_CH = r"(SELECT unnest(regexp_extract_all(html, '[^a-zA-Z0-9\s]')) AS ch FROM pages)"


@query("ep20_special_character_totals", f"""
SELECT count(*) AS total_special_chars, count(DISTINCT ch) AS unique_special_chars,
  {r('count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM documents)')} AS avg_per_document FROM {CH}""")
def _(spark, sf):
    return tidy(p.special_character_totals(docs(spark, sf), **L))


@query("ep20_common_special_characters", f"SELECT ch, count(*) AS n FROM {CH} GROUP BY ch ORDER BY n DESC, ch LIMIT 20")
def _(spark, sf):
    return tidy(p.common_special_characters(docs(spark, sf), **L))


@query("ep20_common_special_characters_of_pages",
       f"SELECT ch, count(*) AS n FROM {PAGE_CH} GROUP BY ch ORDER BY n DESC, ch LIMIT 20")
def _(spark, sf):
    return tidy(p.common_special_characters(load(spark, sf, "pages"), "html", "url"))


@query("ep21_special_characters_by_class", f"""
WITH n AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang)
SELECT n.lang, count(ch) AS total_special_chars, count(DISTINCT ch) AS unique_special_chars,
  {r('count(ch) / CAST(any_value(docs) AS DOUBLE)')} AS avg_per_document
FROM n LEFT JOIN {CH} c USING (lang) GROUP BY n.lang""")
def _(spark, sf):
    return tidy(p.special_characters_by_class(docs(spark, sf), **L))


@query("ep21_common_special_characters_by_class", f"""
SELECT lang, ch, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, ch) AS rank
FROM {CH} GROUP BY lang, ch QUALIFY rank <= 10""")
def _(spark, sf):
    return tidy(p.common_special_characters_by_class(docs(spark, sf), **L))


@query("ep22_pattern_totals", " UNION ALL ".join(
    f"SELECT '{n}' AS pattern, CAST(sum({count_sql('text', pat)}) AS BIGINT) AS matches FROM documents"
    for n, pat in lexicon.COUNTED_PATTERNS.items()))
def _(spark, sf):
    return tidy(p.pattern_totals(docs(spark, sf)))


@query("ep23_special_character_density", f"""
WITH c AS (SELECT lang, ch, count(*) AS n FROM {CH} GROUP BY lang, ch),
top AS (SELECT ch FROM c GROUP BY ch ORDER BY sum(n) DESC, ch LIMIT 10),
d AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang)
SELECT lang, ch, {r('coalesce(n, 0) / CAST(docs AS DOUBLE)')} AS density
FROM d CROSS JOIN top LEFT JOIN c USING (lang, ch)""")
def _(spark, sf):
    return tidy(p.special_character_density(docs(spark, sf), **L))


