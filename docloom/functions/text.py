"""Column expressions over text: tokens, spans, counts. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docloom import lexicon

WS = r"(?U)\s+"
#: White space that one blank does not stand for already.
LONG_WS = r"(?U)\s(?:(?<! )\s*+|\s++)"
WORD = r"[\p{L}\p{N}_]"
# Blanks spelled out: Java matches such a class by table look-up, several times faster than one with \s in it.
BLANKS = r" \t\n\x0B\f\r"
NOT_LETTERS = rf"[^a-z{BLANKS}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def one_blank(text: Column) -> Column:
    """Every run of white space as one blank; runs that are one already are passed over."""
    return F.regexp_replace(text, LONG_WS, " ")


def squeeze(text: Column) -> Column:
    return F.trim(one_blank(text))


def words(text: Column) -> Column:
    """Non-empty whitespace tokens."""
    return F.filter(F.split(text, WS), lambda w: w != "")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def count_of(text: Column, pattern: str) -> Column:
    """Matches of ``pattern``; 0 for NULL text."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def digit_first(text: Column, found: Column, none: Column, digit: str = r"\d") -> Column:
    """``found``, whose patterns all need a digit, or ``none`` for a text without: one scan in place of one per pattern."""
    return F.when(text.rlike(digit), found).otherwise(none)


#: Letters beyond ASCII that patterns with ``(?iu)`` take for ASCII ones: long s, i with and without dot, Kelvin.
FOLDED_LETTERS = ("\u017f", "\u0131", "\u0130", "\u212a")


def may_have(text: Column, literals: Sequence[str], any_case: bool = True) -> Column:
    """False only for texts where no literal occurs, in any case as with ``(?iu)`` or as it stands: a byte search that spares most texts a pattern."""
    if not any_case:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in literals], F.lit(False))
    if not all(x.isascii() for x in literals):
        return F.lit(True)
    found = let(F.lower(text), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(x.lower())) for x in literals], F.lit(False)))
    return found | reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in FOLDED_LETTERS])


def needed_words(pattern: str) -> list[str]:
    """ASCII words one of which every match of the pattern has, if that is plain to see; else none. What is grouped, optional or a class is left out."""
    flat = re.sub(r"\\.", "\0", pattern)
    flat, whole = re.sub(r"\[[^\]]*\]", "\0", flat), None
    choice = re.findall(r"\(\?:([A-Za-z|]+)\)(?![?*{])", flat)
    while flat != whole:
        whole, flat = flat, re.sub(r"\((?:\?:)?[^()]*\)(?:[?*+]|\{[^}]*\})?", "\0", flat)
    flat = re.sub(r".(?:[?*]|\{[^}]*\})", "\0", flat)
    if "|" in flat or "(" in flat:
        return []
    runs = re.findall("[A-Za-z]{3,}", flat)
    return [max(runs, key=len)] if runs else next((c.split("|") for c in choice if min(map(len, c.split("|"))) > 2), [])


def any_of(items: Sequence[str], wrap: str = "(?:{})") -> str:
    """Alternation of literals, longest first."""
    ordered = sorted(items, key=lambda s: (-len(s), s))
    return wrap.format("|".join(quote(i) for i in ordered))


def quote(literal: str) -> str:
    """Escape a literal so that both Java and RE2 read it the same."""
    return "".join(c if c.isalnum() or c in " '_" or ord(c) > 127 else "\\" + c for c in literal)


def rewrite(text: Column, pattern: str,
            gap: Callable[[Column], Column] = lambda g: g,
            span: Callable[[Column], Column] = lambda s: s) -> Column:
    """Replace in one pass: ``span`` rewrites each match, ``gap`` the text between matches.

    The text is cut at the matches, so a replacement is never looked at again. Matches get a mark on either side, which finds them
    in one scan; a text that has the mark itself is cut and searched in two.
    """
    def pieces(t: Column) -> Column:
        marked = F.split(F.regexp_replace(t, pattern, "\0$0\0"), "\0", -1)
        cut = F.transform(marked, lambda x, i: F.when(i % 2 == 1, F.coalesce(span(x), F.lit(""))).otherwise(gap(x)))
        joined = F.zip_with(F.split(t, pattern, -1), matches(t, pattern),
                            lambda g, s: F.concat(gap(g), F.coalesce(span(s), F.lit(""))))
        return F.array_join(F.when(F.contains(t, F.lit("\0")), joined).otherwise(cut), "")
    return let(text, pieces)


def look_up(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*entries), key)


def vocabulary_tokens(text: Column, stopwords: Sequence[str] = lexicon.STOPWORDS) -> Column:
    """Lower-case, delete all but letters and blanks, drop stopwords and single letters."""
    letters = F.regexp_replace(F.lower(text), NOT_LETTERS, "")
    return F.filter(F.split(letters, r"\s+"), lambda w: (F.length(w) > 1) & ~w.isin(list(stopwords)))


def ngram_text(text: Column) -> Column:
    """Lower-case, blank out all but letters, collapse blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), NOT_LETTERS, " "), r"\s+", " "))


def ngram_words(text: Column) -> Column:
    """The words of ``ngram_text``, cut in one scan."""
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")


def word_tokens(text: Column, min_length: int = 2) -> Column:
    """Runs of word characters (letters, digits, underscore of any script), lower-cased."""
    return matches(F.lower(text), rf"{WORD}{{{min_length},}}")


def plain_word_tokens(text: Column, stopwords: Sequence[str] = lexicon.STOPWORDS) -> Column:
    """Words made of a-z only, bounded by non-word characters, without stopwords."""
    return F.filter(word_tokens(text, 1), lambda w: w.rlike("^[a-z]+$") & ~w.isin(list(stopwords)))


def ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.coalesce(grams, F.array().cast("array<string>"))


def run_lengths(tokens: Column) -> Column:
    """Distinct tokens of a row with their counts, ``array<struct<term, tf>>``, without a shuffle."""
    def counted(s: Column) -> Column:
        last = F.size(s)
        firsts = F.filter(F.sequence(F.lit(1), last),
                          lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        return let(firsts, lambda f: F.transform(f, lambda i, k: F.struct(
            F.get(s, i - 1).alias("term"),
            (F.coalesce(F.get(f, k + 1), last + 1) - i).cast("long").alias("tf"),
        )))
    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), counted))


def sentences(text: Column) -> Column:
    """Parts between sentence ends (``.``, ``!`` or ``?`` before a blank or the end)."""
    return F.filter(F.split(text, r"[.!?]+(\s+|$)"), lambda s: s.rlike(r"\S"))


def period_parts(text: Column) -> Column:
    """Non-blank parts between full stops."""
    return F.filter(F.split(text, r"\."), lambda s: s.rlike(r"(?U)\S"))


def ratio(num: Column, den: Column) -> Column:
    """Quotient as double, 0 when the denominator is 0 or NULL."""
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def unnest(df: DataFrame, keep: Sequence[str], items: Column, *names: str) -> DataFrame:
    """One row per array element (or struct element, as columns ``names``), rows without elements dropped.

    The outer form keeps Spark from testing the array for emptiness below the
    generator, which would compute the whole expression a second time.
    """
    made = F.inline_outer(items) if len(names) > 1 else F.explode_outer(items)
    return df.select(*keep, made.alias(*names)).where(F.col(names[0]).isNotNull())
