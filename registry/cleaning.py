"""Cleaning queries. The test texts hold few clinical terms, so lexicons for them are passed in where needed."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from docloom import lexicon
from docloom.functions import cleaning as c
from docloom.functions.text import any_of, quote
from docloom.operators import normalize as n
from registry.common import ORACLES, SQUEEZED, docs, in_list, lit, query, tidy, words_of

# Lexicons made of words that occur in the test texts.
SYNONYMS = {"the": "that one", "thing": "the matter", "of the": "owned by", "in": "inside", "nicht": "kein"}
ABBREVIATIONS = {"THE": "the definite article", "BY": "beside you", "OF": "out front", "IT": "it itself", "LA": "la la"}
SCORES = {"Corpus": {"Number": r"\d+\s*(?:the|and|of|de|la)", "Dotted": r"the\s*:?\s*\d+"},
          **lexicon.SCORE_RULES}
UNITS = ("the", "of", "to", "de", "mg")
CATEGORY = {"Corpus": {"terms": ["The of", "pathetic", "nicht die"], "measurements": [r"\d+\s*the", r"\d+\s*of"]}}
TERMS = ["the of", "pathetic", "disgusting", "la de", *lexicon.PRESERVED_TERMS]
NOT_WORD = r"[^\p{L}\p{N}_]"


def squeezed(spark, sf):
    return n.normalize_whitespace(docs(spark, sf).select("doc_id", "lang", "text"))


def joined(column: str, sep: str = "|"):
    return F.array_join(column, sep)


S = f"(SELECT doc_id, lang, {SQUEEZED} AS text FROM documents)"


@query("n01_whitespace", f"SELECT doc_id, lang, {SQUEEZED} AS text FROM documents")
def _(spark, sf):
    return squeezed(spark, sf)


def _cut(limit: int) -> str:
    head = f"substr(text, 1, {limit})"
    stop = f"(length({head}) - instr(reverse({head}), '.') + 1)"
    return (f"CASE WHEN length(text) <= {limit} THEN text WHEN instr({head}, '.') > 0 AND {stop} > 1 "
            f"THEN substr({head}, 1, {stop}) ELSE {head} END")


@query("n02_length_limit", f"SELECT doc_id, {_cut(3000)} AS text, CAST(length(text) AS BIGINT) AS original_length FROM documents")
def _(spark, sf):
    return n.normalize_length(docs(spark, sf).select("doc_id", "text"), max_length=3000)


PROTECTED = "|".join(f"(?:{p})" for f in ("compound_terms", "ranges", "measurements", "statistical_values")
                     for p in reversed(lexicon.PROTECTED_SPANS[f])).replace(r"\w", r"[\p{L}\p{N}_]")
OUTSIDE = f"array_to_string(string_split_regex(text, {lit(PROTECTED)}), ' ')"


@query("n03_special_characters")
def _(spark, sf):
    out = n.clean_special_characters(squeezed(spark, sf))
    return out.select("doc_id", "text", joined("protected_spans").alias("spans"))


@query("n03_special_character_counts", f"""
WITH o AS (SELECT doc_id, {OUTSIDE} AS outside, len(regexp_extract_all(text, {lit(PROTECTED)})) AS spans FROM {S})
SELECT doc_id, CAST(spans AS BIGINT) AS spans, ch, CAST(length(outside) - length(replace(outside, ch, '')) AS BIGINT) AS n
FROM o, (SELECT unnest([{in_list(lexicon.SPACED_CHARS)}]) AS ch)""")
def _(spark, sf):
    out = n.clean_special_characters(squeezed(spark, sf))
    return tidy(out.select("doc_id", F.size("protected_spans").alias("spans"), F.explode("special_chars").alias("ch", "n")))


def _fold(patterns, replacement, text="text"):
    for p in patterns:
        text = f"regexp_replace({text}, {lit(p)}, {lit(replacement)}, 'g')"
    return text


COMPACT = _fold([r"(\d) *(mg|kg|ml|cm|mm|%)"], r"\1\2")
COMPACT = _fold([r"(\d) *([±/-]) *(\d+)"], r"\1\2\3", COMPACT)


@query("n04_compact_measurements", f"SELECT doc_id, {COMPACT} AS text FROM {S}")
def _(spark, sf):
    d = squeezed(spark, sf)
    return d.select("doc_id", c.compact_measurements(F.col("text")).alias("text"))


OPEN = _fold([r"(\d)\s*(mg|kg|ml|cm|mm)"], r"\1 \2")
OPEN = _fold([r"(\d)\s*%"], r"\1 %", OPEN)
OPEN = _fold([r"(\d+)\s*-\s*(\d+)"], r"\1 - \2", OPEN)
OPEN = _fold([r"\s*±\s*"], " ± ", OPEN)


@query("n05_open_measurements", f"SELECT doc_id, {OPEN} AS text FROM {S}")
def _(spark, sf):
    return squeezed(spark, sf).select("doc_id", c.open_measurements(F.col("text")).alias("text"))


def _scores_sql() -> str:
    parts = [f"list_transform(regexp_extract_all(text, {lit('(?i)' + p)}), lambda m: '{cat}_{kind}: ' || m)"
             for cat, kinds in SCORES.items() for kind, p in kinds.items()]
    whole = parts[0]
    for x in parts[1:]:
        whole = f"list_concat({whole}, {x})"
    return f"SELECT doc_id, array_to_string({whole}, '|') AS scores FROM {S}"


@query("n06_scores", _scores_sql())
def _(spark, sf):
    return n.extract_scores(squeezed(spark, sf), rules=SCORES).select("doc_id", joined("scores").alias("scores"))


@query("n07_abbreviations")
def _(spark, sf):
    out = n.normalize_abbreviations(squeezed(spark, sf), table={**ABBREVIATIONS, **lexicon.ABBREVIATIONS}, units=UNITS)
    return out.select("doc_id", "text", F.array_join(F.array_sort(F.map_keys("expanded")), "|").alias("expanded"))


# Whole-word matches without look-around: separators are doubled, so neighbouring matches do not share one.
DOUBLED = f"' ' || regexp_replace(text, '({NOT_WORD})', '\\1\\1', 'g') || ' '"


def _whole_words(terms) -> str:
    doubled = [t.replace(" ", "  ") for t in terms]
    return "(?:^|" + NOT_WORD + ")" + any_of(doubled, "({})") + "(?:" + NOT_WORD + "|$)"


@query("n07_abbreviation_counts", f"""
SELECT doc_id, CAST(len(list_distinct(regexp_extract_all({DOUBLED}, {lit(_whole_words(ABBREVIATIONS))}, 1))) AS BIGINT) AS abbreviations
FROM {S}""")
def _(spark, sf):
    out = n.normalize_abbreviations(squeezed(spark, sf), table=ABBREVIATIONS, units=UNITS)
    return tidy(out.select("doc_id", F.size("expanded").alias("abbreviations")))


@query("n08_measurement_values", f"""
SELECT doc_id, unit, array_to_string(found, '|') AS found FROM (
  SELECT doc_id, unnest(['the', 'of', 'to', 'de', 'mg']) AS unit, unnest([{", ".join(
      f"regexp_extract_all(text, {lit(rf'(?i)(' + chr(92) + r'd+(?:' + chr(92) + r'.' + chr(92) + r'd+)?)' + chr(92) + f's*{u}(?:{NOT_WORD}|$)')}, 1)"
      for u in UNITS)}]) AS found FROM {S})
WHERE len(found) > 0""")
def _(spark, sf):
    values = F.explode(c.unit_values(F.col("text"), UNITS)).alias("unit", "found")
    return squeezed(spark, sf).select("doc_id", values).select("doc_id", "unit", joined("found").alias("found"))


CORPUS_TABLES = [SYNONYMS, *lexicon.CATEGORY_SYNONYMS.values(), lexicon.COMMON_SYNONYMS, lexicon.FREQUENCY_SYNONYMS]


@query("n09_category_synonyms")
def _(spark, sf):
    tables = [SYNONYMS, *lexicon.CATEGORY_SYNONYMS.values()]
    return n.standardize_terms(squeezed(spark, sf), tables=tables).select("doc_id", "text", F.size("replacements").alias("made"))


def _audit_sql(table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {lit(t)} THEN {lit(x)}" for t, x in table.items())
    return f"""
SELECT doc_id, replace(m, '  ', ' ') AS term, CASE replace(lower(m), '  ', ' ') {cases} END AS replacement
FROM (SELECT doc_id, unnest(regexp_extract_all({DOUBLED}, {lit('(?i)' + _whole_words(table))}, 1)) AS m FROM {S})"""


@query("n10_common_synonyms", f"""
WITH a AS ({_audit_sql({**lexicon.COMMON_SYNONYMS, **SYNONYMS})}),
s AS (SELECT doc_id, count(*) AS made, sum(length(replacement) - length(term)) AS grown FROM a GROUP BY doc_id)
SELECT d.doc_id, coalesce(made, 0) AS made, CAST(length(d.text) + coalesce(grown, 0) AS BIGINT) AS new_length
FROM {S} d LEFT JOIN s USING (doc_id)""")
def _(spark, sf):
    out = n.standardize_terms(squeezed(spark, sf), tables=[{**lexicon.COMMON_SYNONYMS, **SYNONYMS}])
    return tidy(out.select("doc_id", F.size("replacements").alias("made"), F.length("text").alias("new_length")))


@query("n11_frequency_synonyms")
def _(spark, sf):
    table = {"the": "each", "of the": "per", **lexicon.FREQUENCY_SYNONYMS}
    return n.standardize_terms(squeezed(spark, sf), tables=[table]).select("doc_id", "text")


@query("n12_replacement_audit", _audit_sql(SYNONYMS))
def _(spark, sf):
    return n.replacement_audit(squeezed(spark, sf), tables=[SYNONYMS])


def _terms_sql(terms) -> str:
    return f"array_to_string(list_filter([{in_list(terms)}], lambda t: contains(lower(text), lower(t))), '|')"


def _lowered(terms) -> str:
    out = "text"
    for t in terms:
        out = f"regexp_replace({out}, {lit('(?i)' + quote(t))}, {lit(t.lower())}, 'g')"
    return out


@query("n13_category_terms", f"""
SELECT doc_id, {_lowered(CATEGORY['Corpus']['terms'])} AS text, {_terms_sql(CATEGORY['Corpus']['terms'])} AS terms,
  array_to_string(list_concat({", ".join(f"regexp_extract_all(text, {lit('(?i)' + p)})" for p in CATEGORY['Corpus']['measurements'])}), '|') AS measurements
FROM {S}""")
def _(spark, sf):
    out = n.category_step(squeezed(spark, sf), "Corpus", rules=CATEGORY)
    return out.select("doc_id", "text", joined("terms_found").alias("terms"), joined("category_measurements").alias("measurements"))


KEPT = (f"(regexp_matches(t, '^\\d') OR regexp_matches(t, '^[A-Z]{{2,}}$|^[A-Z]{{2,}}-[A-Z]$|^[A-Z][a-z]+[A-Z]+$') "
        f"OR lower(t) IN ({in_list(lexicon.KEPT_WORDS)}))")
STOPPED = f"lower(t) IN ({in_list([*lexicon.DOMAIN_STOPWORDS, *lexicon.STOPWORDS])})"


@query("n14_domain_stopwords", f"""
SELECT doc_id, array_to_string(list_filter({words_of('text')}, lambda t: {KEPT} OR NOT {STOPPED}), ' ') AS text,
  CAST(len(list_filter({words_of('text')}, lambda t: {KEPT})) AS BIGINT) AS preserved,
  CAST(len(list_filter({words_of('text')}, lambda t: NOT {KEPT} AND {STOPPED})) AS BIGINT) AS removed
FROM documents""")
def _(spark, sf):
    out = n.remove_stopwords(docs(spark, sf).select("doc_id", "text"))
    return tidy(out.select("doc_id", "text", F.size("preserved_tokens").alias("preserved"), F.size("removed_stopwords").alias("removed")))


@query("n15_lowercase", "SELECT doc_id, lower(text) AS text FROM documents")
def _(spark, sf):
    return n.lowercase(docs(spark, sf).select("doc_id", "text"))


@query("n16_tokenize")
def _(spark, sf):
    return n.tokenize(docs(spark, sf).select("doc_id", "text")).select("doc_id", "text", joined("token_spans").alias("spans"))


@query("n17_tokenize_improved")
def _(spark, sf):
    out = n.tokenize(docs(spark, sf).select("doc_id", "text"), improved=True)
    return out.select("doc_id", "text", joined("token_spans").alias("spans"))


@query("n18_preserved_terms", f"SELECT doc_id, {_lowered(TERMS)} AS text, {_terms_sql(TERMS)} AS terms FROM {S}")
def _(spark, sf):
    return n.preserve_terms(squeezed(spark, sf), terms=TERMS).select("doc_id", "text", joined("terms_found").alias("terms"))


@query("n19_unify_abbreviations")
def _(spark, sf):
    out = n.unify_abbreviations(squeezed(spark, sf), table={**ABBREVIATIONS, **lexicon.CASE_ABBREVIATIONS})
    return out.select("doc_id", "text", F.array_join(F.array_sort(F.map_keys("abbreviations")), "|").alias("abbreviations"))


@query("n20_unit_mentions", f"""
SELECT doc_id, array_to_string({"list_concat(" * (len(UNITS) - 1)}{", ".join(
    f"regexp_extract_all(text, {lit(rf'(?i)' + chr(92) + 'd+' + chr(92) + f's*{u}')})" + (")" if i else "") for i, u in enumerate(UNITS))}, '|') AS mentions
FROM {S}""")
def _(spark, sf):
    return n.compact_measurements(squeezed(spark, sf), units=UNITS).select("doc_id", joined("unit_mentions").alias("mentions"))


@query("n21_space_by_context")
def _(spark, sf):
    return n.space_by_context(squeezed(spark, sf)).select("doc_id", "text")


@query("n21_context_character_counts", f"""
SELECT doc_id, ch, CAST(length(text) - length(replace(text, ch, '')) AS BIGINT) AS n
FROM documents, (SELECT unnest([{in_list(lexicon.CONTEXT_CHARS)}]) AS ch)""")
def _(spark, sf):
    return n.space_by_context(docs(spark, sf)).select("doc_id", F.explode("char_counts").alias("ch", "n"))


@query("n22_space_after_marks", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '([.,!?])([^\s.,!?])', '\1 \2', 'g')) AS text FROM documents""")
def _(spark, sf):
    return n.standardize_whitespace(docs(spark, sf).select("doc_id", "text"))


@query("n23_numbers", r"""
SELECT doc_id, array_to_string(list_concat(list_concat(regexp_extract_all(text, '\d+\.\d+'), regexp_extract_all(text, '\d+')),
  list_concat(regexp_extract_all(text, '\d+\s*-\s*\d+'), regexp_extract_all(text, '\d+/\d+'))), '|') AS numbers FROM documents""")
def _(spark, sf):
    return n.extract_numbers(docs(spark, sf)).select("doc_id", joined("numbers").alias("numbers"))


# The documents and a few blank ones, which the table has none of.
BLANKS_TOO = "(SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES (-1, NULL), (-2, ''), (-3, '  '), (-4, chr(10) || chr(9))) AS b(doc_id, text))"


def with_blanks(spark, sf):
    blanks = spark.createDataFrame([(-1, None), (-2, ""), (-3, "  "), (-4, "\n\t")], "doc_id long, text string")
    return docs(spark, sf).select("doc_id", "text").unionByName(blanks)


@query("n24_valid_texts", rf"SELECT doc_id, text FROM {BLANKS_TOO} WHERE regexp_matches(text, '\S')")
def _(spark, sf):
    return n.valid_texts(with_blanks(spark, sf))


@query("n24_rejected_texts", rf"SELECT doc_id FROM {BLANKS_TOO} WHERE text IS NULL OR NOT regexp_matches(text, '\S')")
def _(spark, sf):
    return n.rejected_texts(with_blanks(spark, sf)).select("doc_id")


@query("n25_ordered_cleaning")
def _(spark, sf):
    config = n.CleaningConfig(category="ALS", handle_stopwords=True)
    return n.clean_text(docs(spark, sf).select("doc_id", "text"), config).select("doc_id", "text")


@query("n26_cleaning_run")
def _(spark, sf):
    out = n.cleaning_run(docs(spark, sf).select("doc_id", "text"), n.CleaningConfig(max_length=9000))
    return out.select("doc_id", "stats.*")


@query("n26_cleaning_lengths", r"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS original_length,
  CAST(len(regexp_extract_all(text, '\d+\.\d+')) + len(regexp_extract_all(text, '\d+')) + len(regexp_extract_all(text, '\d+\s*-\s*\d+'))
       + len(regexp_extract_all(text, '\d+/\d+')) AS BIGINT) AS numbers_found
FROM documents""")
def _(spark, sf):
    out = n.cleaning_run(docs(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "stats.original_length", "stats.numbers_found")


@query("n28_term_step")
def _(spark, sf):
    out = n.term_step(docs(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "text", joined("terms_found").alias("terms"), joined("unit_mentions").alias("mentions"))


@query("n28_character_step")
def _(spark, sf):
    return n.character_step(docs(spark, sf).select("doc_id", "text")).select("doc_id", "text", joined("numbers").alias("numbers"))


LONE = (f"(SELECT array_to_string(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN x[i] NOT IN ({in_list(lexicon.SPACED_CHARS)}) THEN x[i] "
        "WHEN coalesce(regexp_matches(x[i - 1], '\\s'), false) OR coalesce(regexp_matches(x[i + 1], '\\s'), false) THEN x[i] ELSE ' ' || x[i] || ' ' END), '') "
        "FROM (SELECT string_split(gap, '') AS x))")


def _special_sql() -> str:
    """Pieces as rows: gaps with lone marks set apart, spans as they are; then measurements are opened."""
    return f"""
WITH p AS (SELECT doc_id, string_split_regex(text, {lit(PROTECTED)}) AS gaps, regexp_extract_all(text, {lit(PROTECTED)}) AS spans FROM {S}),
u AS (SELECT doc_id, spans, unnest(gaps) AS gap, unnest(range(1, len(gaps) + 1)) AS i FROM p),
m AS (SELECT doc_id, any_value(spans) AS spans, string_agg(regexp_replace({LONE}, '\\s+', ' ', 'g') || coalesce(spans[i], ''), '' ORDER BY i) AS text FROM u GROUP BY doc_id)
SELECT doc_id, {OPEN} AS text, array_to_string(spans, '|') AS spans FROM m"""


# ---- texts cut at their matches and put together again, as SQL ------------------------------

def step(source: str, name: str, pattern: str, span: str = "_s", gap: str = "_g", carry: str = "") -> str:
    """A CTE that rebuilds the column ``text`` of ``source`` from ``span`` of each match ``_s`` and ``gap`` of each piece ``_g`` between; each text is cut once."""
    return (f"{name} AS (SELECT doc_id{carry}, text AS before, spans, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: {gap.replace('_g', 'gaps[i]')} || "
            f"coalesce({span.replace('_s', 'spans[i]')}, '')), '') AS text FROM (SELECT *, string_split_regex(text, {lit(pattern)}) AS gaps, "
            f"regexp_extract_all(text, {lit(pattern)}) AS spans FROM {source}))")


def word_step(source: str, name: str, terms: dict[str, str], case: str = "(?i)", carry: str = "") -> str:
    """CTEs that rewrite whole words: separators are doubled, so that neighbouring matches do not share one, and made single again.

    ``terms`` maps a word as it is looked up to an SQL expression, which may use ``before``, the text as it came.
    """
    doubled = f"SELECT * REPLACE ('  ' || regexp_replace(text, '({NOT_WORD})', '\\1\\1', 'g') || '  ' AS text), text AS whole FROM {source}"
    pattern = f"{case}{NOT_WORD}(?:{'|'.join(quote(t).replace(' ', '  ') for t in sorted(terms, key=lambda t: -len(t)))}){NOT_WORD}"
    core = "substr(spans[i], 2, length(spans[i]) - 2)"
    key = f"lower({core})" if case else core
    cases = " ".join(f"WHEN {lit(t.replace(' ', '  '))} THEN {e}" for t, e in terms.items())
    new = f"spans[i][1] || coalesce(CASE {key} {cases} END, {core}) || spans[i][-1]"
    body = f"array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce({new}, '')), '')"
    return f"""{name}d AS ({doubled}),
{name}c AS (SELECT *, string_split_regex(text, {lit(pattern)}) AS gaps, regexp_extract_all(text, {lit(pattern)}) AS spans FROM {name}d),
{name}r AS (SELECT doc_id{carry}, whole AS before, len(spans) AS made, {body} AS text FROM {name}c),
{name} AS (SELECT * REPLACE (substr(regexp_replace(text, '({NOT_WORD}){NOT_WORD}', '\\1', 'g'), 2, length(regexp_replace(text, '({NOT_WORD}){NOT_WORD}', '\\1', 'g')) - 2) AS text) FROM {name}r)"""


def replaced(table: dict[str, str]) -> dict[str, str]:
    """Replacements of a synonym table for ``word_step``."""
    return {t: lit(re.sub(f"({NOT_WORD_ASCII})", r"\1\1", x)) for t, x in table.items()}


NOT_WORD_ASCII = r"[^\w]"


def by_context(text: str, mark: str, side: str) -> str:
    """A blank on both sides of ``mark`` unless each of its neighbours is of the class ``side``."""
    near = lambda k: f"coalesce(regexp_matches(x[i {k} 1], '{side}'), false)"
    return (f"(SELECT array_to_string(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN x[i] <> '{mark}' THEN x[i] WHEN {near('-')} AND {near('+')} THEN x[i] "
            f"ELSE ' {mark} ' END), '') FROM (SELECT string_split({text}, '') AS x))")


def _chain_sql(tables, made: str = "made", more: str = "") -> str:
    """Synonym tables one after the other."""
    ctes = [f"t0 AS (SELECT doc_id, text, CAST(0 AS BIGINT) AS total FROM {S})"]
    for k, table in enumerate(tables):
        ctes.append(word_step(f"t{k}", f"x{k}", replaced(table), carry=", total"))
        ctes.append(f"t{k + 1} AS (SELECT doc_id, text, total + made AS total FROM x{k})")
    return f"WITH {', '.join(ctes)} SELECT doc_id, text{more} FROM t{len(tables)}"


def _tokens_sql(improved: bool) -> str:
    pattern = c.token_pattern()
    gap = "regexp_replace(_g, '([A-Z]-[A-Z])', ' \\1 ', 'g')" if improved else "_g"
    return f"""WITH {step('documents', 't', pattern, gap=f"regexp_replace({gap}, '\\s+', ' ', 'g')")}
SELECT doc_id, trim(text) AS text, array_to_string(spans, '|') AS spans FROM t"""


def _unify(source: str, name: str, table: dict[str, str]) -> str:
    return word_step(source, name, {a.lower(): f"CASE WHEN contains(whole, {lit(a)}) THEN {lit(a)} END" for a in table}, case="")


def _spaced(text: str) -> str:
    for mark, side in (("-", "[\\p{L}\\p{N}]"), ("/", "[\\d\\s]"), ("%", "\\d"), ("±", "[\\d\\s]")):
        text = by_context(text, mark, side)
    return text


MARKED = "regexp_replace(text, '([.,])', ' \\1 ', 'g')"
UNIT_PATTERN = r"(?i)\d+\s*" + any_of(lexicon.COMPACT_UNITS)
MENTIONS = "list_concat(" * (len(lexicon.COMPACT_UNITS) - 1) + ", ".join(
    f"regexp_extract_all(before, {lit(rf'(?i)' + chr(92) + 'd+' + chr(92) + f's*{quote(u)}')})" + (")" if i else "") for i, u in enumerate(lexicon.COMPACT_UNITS))
UNIFIED = {**ABBREVIATIONS, **lexicon.CASE_ABBREVIATIONS}

ORACLES.update({
    "n03_special_characters": _special_sql(),
    "n09_category_synonyms": _chain_sql([SYNONYMS, *lexicon.CATEGORY_SYNONYMS.values()], more=", total AS made"),
    "n11_frequency_synonyms": _chain_sql([{"the": "each", "of the": "per", **lexicon.FREQUENCY_SYNONYMS}]),
    "n16_tokenize": _tokens_sql(False),
    "n17_tokenize_improved": _tokens_sql(True),
    "n19_unify_abbreviations": f"""WITH {_unify(S, 't', UNIFIED)}
SELECT doc_id, text, array_to_string(list_sort(list_filter([{in_list(UNIFIED)}], lambda a: contains(before, a))), '|') AS abbreviations FROM t""",
    "n21_space_by_context": f"SELECT doc_id, {_spaced(MARKED)} AS text FROM {S}",
    "n28_character_step": f"""WITH t AS (SELECT doc_id, {_spaced(MARKED)} AS text FROM documents)
SELECT doc_id, text, array_to_string(list_concat(list_concat(regexp_extract_all(text, '\\d+\\.\\d+'), regexp_extract_all(text, '\\d+')),
  list_concat(regexp_extract_all(text, '\\d+\\s*-\\s*\\d+'), regexp_extract_all(text, '\\d+/\\d+'))), '|') AS numbers FROM t""",
    "n28_term_step": f"""WITH {_unify('(SELECT doc_id, text FROM documents)', 'a', lexicon.CASE_ABBREVIATIONS)},
b AS (SELECT doc_id, {_lowered(lexicon.PRESERVED_TERMS)} AS text, {_terms_sql(lexicon.PRESERVED_TERMS)} AS terms FROM a),
{step('b', 'd', UNIT_PATTERN, span="lower(replace(_s, ' ', ''))", carry=', terms')}
SELECT doc_id, text, terms, array_to_string({MENTIONS}, '|') AS mentions FROM d""",
})
