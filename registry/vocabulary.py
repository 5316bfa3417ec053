"""Vocabulary and n-gram queries."""

from __future__ import annotations

from docloom.operators import vocabulary as v
from registry.common import NGRAM_TEXT, PLAIN_TOKENS, STOP, VOCAB_TOKENS, docs, load, query, r, tidy

WORD_ROWS = f"(SELECT lang, unnest({VOCAB_TOKENS}) AS word FROM documents)"


@query("v01_vocabulary_tokens", f"SELECT doc_id, lang, array_to_string({VOCAB_TOKENS}, ' ') AS tokens FROM documents")
def _(spark, sf):
    return v.vocabulary(docs(spark, sf), label="lang").selectExpr("doc_id", "lang", "array_join(tokens, ' ') AS tokens")


@query("v02_label_vocabulary", f"""
WITH n AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang)
SELECT lang, count(DISTINCT word) AS unique_words, count(word) AS total_words,
  {r('count(word) / CAST(any_value(docs) AS DOUBLE)')} AS avg_words_per_doc
FROM n LEFT JOIN {WORD_ROWS} USING (lang) GROUP BY lang""")
def _(spark, sf):
    return tidy(v.label_vocabulary(docs(spark, sf), label="lang"))


@query("v02_top_words", f"""
SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
FROM {WORD_ROWS} GROUP BY lang, word QUALIFY rank <= 10""")
def _(spark, sf):
    return tidy(v.top_words(docs(spark, sf), label="lang"))


@query("v03_word_frequency", f"SELECT word, count(*) AS frequency FROM {WORD_ROWS} GROUP BY word")
def _(spark, sf):
    return tidy(v.word_frequency(docs(spark, sf)))


@query("v04_zipf_table", f"""
WITH f AS (SELECT word, count(*) AS frequency FROM {WORD_ROWS} GROUP BY word),
k AS (SELECT *, row_number() OVER (ORDER BY frequency DESC, word) AS rank FROM f)
SELECT word, frequency, rank, {r('log10(frequency)')} AS log_freq, {r('log10(rank)')} AS log_rank FROM k""")
def _(spark, sf):
    return tidy(v.zipf_table(docs(spark, sf)))


@query("v05_vocabulary_overview", f"""
WITH f AS (SELECT word, count(*) AS frequency FROM {WORD_ROWS} GROUP BY word)
SELECT count(*) AS unique_words, CAST(sum(frequency) AS BIGINT) AS total_words, {r('avg(frequency)')} AS avg_frequency FROM f""")
def _(spark, sf):
    return tidy(v.vocabulary_overview(docs(spark, sf)))


CLASS_SCORES = f"""
t AS (SELECT doc_id, lang, term, count(*) AS tf FROM (SELECT doc_id, lang, unnest({PLAIN_TOKENS}) AS term FROM documents)
  GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
vo AS (SELECT term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM t, n GROUP BY term, n HAVING count(*) >= 10),
w AS (SELECT doc_id, lang, term, tf * idf AS w FROM t JOIN vo USING (term)),
u AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w),
s AS (SELECT lang, term, sum(weight) AS s FROM u GROUP BY lang, term),
sa AS (SELECT term, sum(s) AS s_all FROM s GROUP BY term),
d AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
sc AS (SELECT lang, term, coalesce(s, 0) / docs AS score,
  coalesce(s, 0) / docs - (s_all - coalesce(s, 0)) / (n - docs) AS distinctiveness
  FROM sa CROSS JOIN d CROSS JOIN n LEFT JOIN s USING (lang, term)),
rs AS (SELECT lang, term, {r('score')} AS score, {r('distinctiveness')} AS distinctiveness FROM sc)"""
TOP = "SELECT lang, term, {0}, row_number() OVER (PARTITION BY lang ORDER BY {0} DESC, term) AS rank FROM rs QUALIFY rank <= 20"


def _scores(spark, sf):
    return v.class_term_scores(docs(spark, sf), label="lang")


@query("v06_class_profile", f"WITH {CLASS_SCORES} {TOP.format('score')}")
def _(spark, sf):
    return tidy(v.class_profile(_scores(spark, sf), "lang"))


@query("v07_distinctive_words", f"WITH {CLASS_SCORES} {TOP.format('distinctiveness')}")
def _(spark, sf):
    return tidy(v.class_profile(_scores(spark, sf), "lang", by="distinctiveness"))


@query("v08_vocabulary_overlap", f"""
WITH {CLASS_SCORES}, top AS ({TOP.format('score')}), s AS (SELECT lang, list(term) AS terms FROM top GROUP BY lang)
SELECT a.lang AS label_a, b.lang AS label_b, {r("len(list_intersect(a.terms, b.terms)) / CAST(len(list_distinct(list_concat(a.terms, b.terms))) AS DOUBLE)")}
  AS overlap FROM s a, s b""".replace("s AS (SELECT lang, list", "sets AS (SELECT lang, list").replace("FROM s a, s b", "FROM sets a, sets b"))
def _(spark, sf):
    return tidy(v.vocabulary_overlap(v.class_profile(_scores(spark, sf), "lang"), "lang"))


@query("v09_ngram_text", f"SELECT doc_id, lang, {NGRAM_TEXT} AS text FROM documents")
def _(spark, sf):
    return v.clean_for_ngrams(docs(spark, sf), label="lang")


def ngram_cte(table: str, label: str) -> str:
    nxt = "lead(w, {}) OVER (PARTITION BY rid ORDER BY pos)"
    return f"""
tk AS (SELECT row_number() OVER () AS rid, {label}, list_filter(string_split({NGRAM_TEXT}, ' '), lambda w: w <> '') AS t
  FROM {table}),
wp AS (SELECT rid, {label}, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM tk),
ww AS (SELECT {label}, w, {nxt.format(1)} AS w2, {nxt.format(2)} AS w3 FROM wp),
g AS (SELECT {label}, 1 AS n, w AS gram FROM ww WHERE w NOT IN ({STOP})
  UNION ALL SELECT {label}, 2, w || ' ' || w2 FROM ww WHERE w2 IS NOT NULL
  UNION ALL SELECT {label}, 3, w || ' ' || w2 || ' ' || w3 FROM ww WHERE w3 IS NOT NULL),
c AS (SELECT {label}, CAST(n AS BIGINT) AS n, gram, count(*) AS count FROM g GROUP BY {label}, n, gram)"""


@query("v10_ngram_counts", f"WITH {ngram_cte('documents', 'lang')} SELECT * FROM c")
def _(spark, sf):
    return tidy(v.ngram_counts(docs(spark, sf), label="lang"))


@query("v11_top_ngrams", f"""
WITH {ngram_cte('documents', 'lang')}
SELECT *, row_number() OVER (PARTITION BY lang, n ORDER BY count DESC, gram) AS rank FROM c QUALIFY rank <= 10""")
def _(spark, sf):
    return tidy(v.top_ngrams(v.ngram_counts(docs(spark, sf), label="lang"), "lang"))


@query("v11_top_ngrams_by_role", f"""
WITH {ngram_cte('conversations', 'role')}
SELECT *, row_number() OVER (PARTITION BY role, n ORDER BY count DESC, gram) AS rank FROM c QUALIFY rank <= 15""")
def _(spark, sf):
    counts = v.ngram_counts(load(spark, sf, "conversations"), label="role")
    return tidy(v.top_ngrams(counts, "role", 15))


DISTINCTIVE = """, k AS (SELECT count(DISTINCT lang) AS k FROM c),
x AS (SELECT c.*, count * ln(CAST(k AS DOUBLE) / count(*) OVER (PARTITION BY n, gram)) AS score FROM c, k)"""


@query("v12_distinctive_ngrams", f"""
WITH {ngram_cte('documents', 'lang')}{DISTINCTIVE} SELECT lang, n, gram, count, {r('score')} AS score FROM x""")
def _(spark, sf):
    return tidy(v.distinctive_ngrams(docs(spark, sf), label="lang"))
