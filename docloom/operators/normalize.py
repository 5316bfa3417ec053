"""Text cleaning as narrow projections: ``(…, text) -> (…, text, audit columns)``.

Every step works inside the row, so a chain of them is one projection over the
scan. NULL text stays NULL; its counts are 0 and its lists NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from docloom import lexicon
from docloom.functions import cleaning as c
from docloom.functions.text import matches, squeeze, unnest, words


def normalize_whitespace(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, squeeze(F.col(text)))


def normalize_length(df: DataFrame, text: str = "text", max_length: int = 9000) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.cut_length(t, max_length), "original_length": F.length(t).cast("long")})


def clean_special_characters(df: DataFrame, text: str = "text", improved: bool = True) -> DataFrame:
    """Space out special characters outside protected spans, then standardize measurements.

    Adds the characters counted and the protected spans. ``improved`` writes
    ``5 mg`` and ``3 - 5``, otherwise measurements become compact.
    """
    t = F.col(text)
    standard = c.open_measurements if improved else c.compact_measurements
    return df.withColumns({text: standard(c.space_characters(t)),
                           "special_chars": c.spaced_character_counts(t),
                           "protected_spans": c.protected_spans(t)})


def extract_scores(df: DataFrame, text: str = "text",
                   rules: dict[str, dict[str, str]] = lexicon.SCORE_RULES) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.squeeze_scores(t, rules), "scores": c.score_list(t, rules)})


def normalize_abbreviations(df: DataFrame, text: str = "text", table: dict[str, str] = lexicon.ABBREVIATIONS,
                            units: Sequence[str] = tuple(lexicon.UNIT_NAMES)) -> DataFrame:
    """Write measurements as ``value unit`` and abbreviations out at their first occurrence."""
    spaced = df.withColumns({text: c.space_units(F.col(text), units), "measurements": c.unit_values(F.col(text), units)})
    done = spaced.withColumn("_done", c.expand_abbreviations(F.col(text), table))
    return done.withColumns({text: F.col("_done.text"), "expanded": F.col("_done.expanded")}).drop("_done")


def standardize_terms(df: DataFrame, text: str = "text",
                      tables: Sequence[dict[str, str]] | None = None) -> DataFrame:
    """Replace synonyms table by table; adds ``replacements`` as ``term → replacement``.

    Within a table replacements do not chain, from one table to the next they do.
    """
    if tables is None:
        tables = [*lexicon.CATEGORY_SYNONYMS.values(), lexicon.COMMON_SYNONYMS, lexicon.FREQUENCY_SYNONYMS]
    out = df.withColumn("replacements", F.array().cast("array<string>"))
    for table in tables:
        t = F.col(text)
        out = out.withColumns({text: c.replace_synonyms(t, table),
                               "replacements": F.concat("replacements", c.synonym_audit(t, table))})
    return out


def replacement_audit(df: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """One row per replacement: ``(id, term, replacement)``."""
    made = unnest(standardize_terms(df, text, **options), [id], F.col("replacements"), "r")
    parts = F.split("r", " → ")
    return made.select(id, F.get(parts, 0).alias("term"), F.get(parts, 1).alias("replacement"))


def category_step(df: DataFrame, category: str, text: str = "text",
                  rules: dict[str, dict[str, list[str]]] = lexicon.CATEGORY_RULES) -> DataFrame:
    """Lower-case the category's terms, list those found and the category's measurements."""
    rule = rules.get(category, {"terms": [], "measurements": []})
    t = F.col(text)
    none = F.array().cast("array<string>")
    terms = c.terms_found(t, rule["terms"]) if rule["terms"] else none
    found = F.concat(*[matches(t, f"(?i){p}") for p in rule["measurements"]]) if rule["measurements"] else none
    lowered = c.lower_terms(t, rule["terms"]) if rule["terms"] else t
    return df.withColumns({text: lowered, "terms_found": terms, "category_measurements": found})


def remove_stopwords(df: DataFrame, text: str = "text", category: str | None = None,
                     domain: Sequence[str] = lexicon.DOMAIN_STOPWORDS,
                     kept: Sequence[str] = lexicon.KEPT_WORDS) -> DataFrame:
    """Drop domain and English stopwords, but never values, abbreviations or listed words."""
    tokens = words(F.col(text))

    def stays(t: Column) -> Column:
        # looked up first: few tokens are stopwords, so few meet the patterns of the kept ones
        return ~c.is_stopword(t, domain) | c.is_kept_token(t, category, kept)

    return df.withColumns({
        text: F.array_join(F.filter(tokens, stays), " "),
        "preserved_tokens": F.filter(tokens, lambda t: c.is_kept_token(t, category, kept)),
        "removed_stopwords": F.filter(tokens, lambda t: ~stays(t)),
    })


def lowercase(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, F.lower(text))


def tokenize(df: DataFrame, text: str = "text", improved: bool = False, split_capitals: bool = False,
             spans: dict[str, str] = lexicon.TOKEN_SPANS) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.tokenize_spaced(t, spans, improved, split_capitals),
                           "token_spans": matches(t, c.token_pattern(spans))})


def preserve_terms(df: DataFrame, text: str = "text", terms: Sequence[str] = lexicon.PRESERVED_TERMS) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.lower_terms(t, terms), "terms_found": c.terms_found(t, terms)})


def unify_abbreviations(df: DataFrame, text: str = "text",
                        table: dict[str, str] = lexicon.CASE_ABBREVIATIONS) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.unify_case(t, table), "abbreviations": c.abbreviations_present(t, table)})


def compact_measurements(df: DataFrame, text: str = "text", units: Sequence[str] = lexicon.COMPACT_UNITS) -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.compact_units(t, units), "unit_mentions": c.unit_mentions(t, units)})


def space_by_context(df: DataFrame, text: str = "text") -> DataFrame:
    t = F.col(text)
    return df.withColumns({text: c.space_by_context(t), "char_counts": c.character_counts(t)})


def standardize_whitespace(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, c.space_after_marks(F.col(text)))


def extract_numbers(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("numbers", c.number_list(F.col(text)))


def is_valid_text(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def valid_texts(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(is_valid_text(F.col(text)))


def rejected_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows ``valid_texts`` leaves out: NULL or blank text."""
    return df.where(~is_valid_text(F.col(text)))


def term_step(df: DataFrame, text: str = "text") -> DataFrame:
    """Unify abbreviations, preserve terms, compact measurements, as one step."""
    return df.transform(unify_abbreviations, text).transform(preserve_terms, text).transform(compact_measurements, text)


def character_step(df: DataFrame, text: str = "text") -> DataFrame:
    """Space special characters by context, then list the numbers, as one step."""
    return df.transform(space_by_context, text).transform(extract_numbers, text)


@dataclass(frozen=True)
class CleaningConfig:
    """Switches of the ordered cleaning chain."""

    category: str | None = None
    max_length: int | None = None
    preserve_case: bool = True
    include_scores: bool = True
    standardize_terms: bool = True
    handle_stopwords: bool = False
    split_capitals: bool = False


def clean_text(df: DataFrame, config: CleaningConfig = CleaningConfig(), text: str = "text") -> DataFrame:
    """The ordered chain: blanks, length, characters, scores, abbreviations, synonyms,
    category, stopwords, case, tokens; with a ``max_length``, then the hard cap. Audit columns are kept."""
    out = df.transform(normalize_whitespace, text)
    if config.max_length is None:
        out = out.withColumn("original_length", F.length(text).cast("long"))
    else:
        out = normalize_length(out, text, config.max_length)
    out = clean_special_characters(out, text)
    if config.include_scores:
        out = extract_scores(out, text)
    out = normalize_abbreviations(out, text)
    if config.standardize_terms:
        out = standardize_terms(out, text)
    if config.category:
        out = category_step(out, config.category, text)
    if config.handle_stopwords:
        out = remove_stopwords(out, text, config.category)
    if not config.preserve_case:
        out = lowercase(out, text)
    out = tokenize(out, text, improved=True, split_capitals=config.split_capitals)
    return out if config.max_length is None else out.withColumn(text, F.substring(text, 1, config.max_length))


def cleaning_run(df: DataFrame, config: CleaningConfig = CleaningConfig(), text: str = "text") -> DataFrame:
    """Cleaned text with the five figures of a run: lengths, characters spaced, numbers, terms."""
    raw = df.withColumn("_raw", F.col(text))
    out = clean_text(raw, config, text)
    listed = [F.size(n) for n in ("replacements", "terms_found", "preserved_tokens") if n in out.columns]
    terms = sum(listed, F.lit(0))
    chars = F.aggregate(F.map_values("special_chars"), F.lit(0).cast("long"), lambda a, x: a + x)
    stats = F.struct(F.length("_raw").cast("long").alias("original_length"),
                     F.length(text).cast("long").alias("processed_length"),
                     F.coalesce(chars, F.lit(0)).alias("special_chars_removed"),
                     F.coalesce(F.size(c.number_list(F.col("_raw"))), F.lit(0)).cast("long").alias("numbers_found"),
                     F.coalesce(terms, F.lit(0)).cast("long").alias("medical_terms_preserved"))
    return out.withColumn("stats", stats).select(*[x for x in df.columns], "stats")
