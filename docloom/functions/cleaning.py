"""Cleaning rules as column expressions: text in, text (or an audit value) out."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from docloom import lexicon
from docloom.functions.text import LONG_WS, any_of, digit_first, let, look_up, matches, may_have, needed_words, one_blank, quote, rewrite, squeeze

ANY_CASE = "(?iuU)"
NO_STRINGS = "array<string>"
#: Digits of any script, as in patterns with ``(?U)``.
ANY_DIGIT = r"\p{Nd}"
#: Every fixed protected span has one of these, and most texts have none.
MAY_BE_PROTECTED = r"[-/\p{Nd}]"


def needs_digit(patterns: Sequence[str]) -> bool:
    """Whether each pattern starts or ends with digits that it cannot do without."""
    def one(p: str) -> bool:
        whole, flat = None, p
        while flat != whole:
            whole, flat = flat, re.sub(r"\((?:\?:)?[^()]*\)\??", "", flat)
        return "|" not in flat and (p.startswith(r"\d+") or (p.endswith(r"\d+") and not p.endswith(r"\\d+")))
    return all(one(p) for p in patterns)


def no_strings(text: Column) -> Column:
    """An empty array, NULL for NULL text."""
    return F.when(text.isNotNull(), F.array().cast(NO_STRINGS))


def protected_pattern(spans: dict[str, list[str]] = lexicon.PROTECTED_SPANS) -> str:
    """One alternation for all protected spans; where two start together the longer comes first."""
    families = ["compound_terms", "ranges", "measurements", "statistical_values"]
    ordered = [p for f in families for p in reversed(spans[f])]
    # Possessive words: a word never gives back letters, which only saves retries.
    return "(?U)" + "|".join(f"(?:{p})" for p in ordered).replace(r"\w+", r"\w++")


def cut_length(text: Column, max_length: int = 9000) -> Column:
    """Cut a longer text, then go back to its last full stop unless that is the first character."""
    def cut(head: Column) -> Column:
        stop = F.length(head) - F.instr(F.reverse(head), ".") + 1
        at_stop = (F.instr(head, ".") > 0) & (stop > 1)
        return F.when(at_stop, F.substring(head, F.lit(1), stop)).otherwise(head)
    return let(text, lambda t: F.when(F.length(t) > max_length, let(F.substring(t, 1, max_length), cut)).otherwise(t))


def space_characters(text: Column, chars: Sequence[str] = lexicon.SPACED_CHARS) -> Column:
    """Set the listed characters apart by blanks, except inside protected spans."""
    listed = "[" + "".join("\\" + c for c in chars) + "]"
    # the character first: looking back from every position would take most of the time
    lone = rf"(?U)({listed})(?<!\s{listed})(?!\s)"
    gap = lambda g: one_blank(F.regexp_replace(g, lone, " $1 "))

    def spaced(t: Column) -> Column:
        return F.when(t.rlike(MAY_BE_PROTECTED), rewrite(t, protected_pattern(), gap=gap)).otherwise(gap(t))
    # without such a character, and with single blanks only, no gap would change
    return let(text, lambda t: F.when((may_have(t, chars, any_case=False) & t.rlike(lone)) | t.rlike(LONG_WS), spaced(t)).otherwise(t))


def protected_spans(text: Column) -> Column:
    return F.when(text.rlike(MAY_BE_PROTECTED), matches(text, protected_pattern())).otherwise(no_strings(text))


def spaced_character_counts(text: Column, chars: Sequence[str] = lexicon.SPACED_CHARS) -> Column:
    """Map of each listed character to its count outside protected spans."""
    def count(outside: Column) -> Column:
        entries = [x for c in chars for x in (F.lit(c), F.regexp_count(outside, F.lit(quote(c))).cast("long"))]
        return F.create_map(*entries)
    outside = F.when(text.rlike(MAY_BE_PROTECTED), F.array_join(F.split(text, protected_pattern(), -1), " ")).otherwise(text)
    return let(outside, count)


def compact_measurements(text: Column) -> Column:
    """``5 mg`` to ``5mg``, ``3 - 5`` to ``3-5``: no blanks inside measurements and ranges."""
    for pattern in lexicon.PROTECTED_SPANS["measurements"] + lexicon.PROTECTED_SPANS["ranges"]:
        text = rewrite(text, pattern, span=lambda s: F.replace(s, F.lit(" "), F.lit("")))
    return text


def open_measurements(text: Column) -> Column:
    """``5mg`` to ``5 mg``, ``3-5`` to ``3 - 5``, blanks around ``±``."""
    def opened(text: Column) -> Column:
        out = F.regexp_replace(text, r"(\d)\s*(mg|kg|ml|cm|mm)", "$1 $2")
        out = F.regexp_replace(out, r"(\d)\s*%", "$1 %")
        out = F.regexp_replace(out, r"(\d+)\s*-\s*(\d+)", "$1 - $2")
        return let(digit_first(text, out, text), lambda t: F.when(F.contains(t, F.lit("±")), F.regexp_replace(t, r"\s*±\s*", " ± ")).otherwise(t))
    return let(text, opened)


def score_list(text: Column, rules: dict[str, dict[str, str]] = lexicon.SCORE_RULES) -> Column:
    """All score mentions as ``category_kind: match``."""
    def named(name: str, pattern: str) -> Column:
        found = F.transform(matches(text, f"(?i){pattern}"), lambda m: F.concat(F.lit(f"{name}: "), m))
        return digit_first(text, found, no_strings(text)) if needs_digit([pattern]) else found
    return F.concat(*[named(f"{c}_{k}", p) for c, kinds in rules.items() for k, p in kinds.items()])


def guarded(change: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """``change`` of texts with a digit only."""
    def run(t: Column) -> Column:
        return digit_first(t, change(t), t)
    return run


def squeeze_scores(text: Column, rules: dict[str, dict[str, str]] = lexicon.SCORE_RULES) -> Column:
    """Collapse blanks inside score mentions."""
    patterns = [p for kinds in rules.values() for p in kinds.values()]
    words = [needed_words(p) for p in patterns]

    def squeezed(t: Column) -> Column:
        for p in patterns:
            changed = lambda t, p=p: rewrite(t, f"(?i){p}", span=squeeze)
            t = let(t, guarded(changed)) if needs_digit([p]) else changed(t)
        return t
    if not all(words):
        return squeezed(text)
    return let(text, lambda t: F.when(may_have(t, sum(words, [])), squeezed(t)).otherwise(t))


def expand_abbreviations(text: Column, table: dict[str, str] = lexicon.ABBREVIATIONS, window: int = 50) -> Column:
    """Struct of the text with abbreviations written out, and the map of those changed.

    The first occurrence of an abbreviation becomes ``full form (ABBR)``, unless the
    full form stands within ``window`` characters of it. One walk over the matches;
    what precedes a match is seen as already rewritten.
    """
    pattern = "(?U)" + any_of(table, r"\b(?:{})\b")

    def walk(spans: Column, gaps: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"),
                         F.array().cast(NO_STRINGS).alias("changed"))

        def step(acc: Column, k: Column) -> Column:
            abbr, gap = F.get(spans, k), F.get(gaps, k)
            before = F.concat(acc.out, gap)
            pos = acc.pos + F.length(gap) + F.length(abbr)
            after = F.substring(text, pos + 1, F.lit(window))
            near = F.lower(F.concat(F.substring(before, F.greatest(F.length(before) - window + 1, F.lit(1)), F.lit(window)),
                                    abbr, after))
            full = look_up(table, abbr)
            change = (F.array_position(spans, abbr) == k + 1) & ~F.contains(near, F.lower(full))
            return F.struct(
                F.concat(before, F.when(change, F.concat(full, F.lit(" ("), abbr, F.lit(")"))).otherwise(abbr)).alias("out"),
                pos.alias("pos"),
                F.when(change, F.array_append(acc.changed, abbr)).otherwise(acc.changed).alias("changed"),
            )

        def finish(acc: Column) -> Column:
            return F.struct(
                F.concat(acc.out, F.get(gaps, F.size(spans))).alias("text"),
                F.map_from_arrays(acc.changed, F.transform(acc.changed, lambda a: look_up(table, a))).alias("expanded"),
            )

        steps = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.size(spans) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start, step, finish)

    parts = F.struct(matches(text, pattern).alias("spans"), F.split(text, pattern, -1).alias("gaps"))
    nothing = F.struct(text.alias("text"), F.create_map().cast("map<string,string>").alias("expanded"))
    found = may_have(text, list(table), any_case=False) & F.regexp_like(text, F.lit(pattern))
    return F.when(found, let(parts, lambda p: walk(p.spans, p.gaps))).otherwise(nothing)


def unit_values(text: Column, units: Sequence[str] = tuple(lexicon.UNIT_NAMES)) -> Column:
    """Map of unit to the numbers in front of it; units without a number are left out."""
    entries = [F.struct(F.lit(u).alias("unit"), matches(text, unit_pattern(u), 1).alias("found")) for u in units]
    found = F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e.found) > 0))
    return digit_first(text, found, F.create_map().cast("map<string,array<string>>"), ANY_DIGIT)


def unit_pattern(unit: str) -> str:
    return rf"{ANY_CASE}(\d+(?:\.\d+)?)\s*{quote(unit)}\b"


def space_units(text: Column, units: Sequence[str] = tuple(lexicon.UNIT_NAMES)) -> Column:
    """Write each measurement as ``value unit``."""
    def spaced(text: Column) -> Column:
        out = text
        for unit in units:
            out = F.regexp_replace(out, unit_pattern(unit), f"$1 {unit}")
        return digit_first(text, out, text, ANY_DIGIT)
    return let(text, spaced)


def synonym_pattern(table: dict[str, str]) -> str:
    return ANY_CASE + any_of(table, r"\b(?:{})\b")


def replace_synonyms(text: Column, table: dict[str, str]) -> Column:
    """Replace the terms of one table, whole words in any case; replacements do not chain."""
    changed = lambda t: rewrite(t, synonym_pattern(table), span=lambda s: F.coalesce(look_up(table, F.lower(s)), s))
    return let(text, lambda t: F.when(may_have(t, list(table)), changed(t)).otherwise(t))


def synonym_audit(text: Column, table: dict[str, str]) -> Column:
    """The replacements ``replace_synonyms`` makes, as ``term → replacement``."""
    return F.transform(matches(text, synonym_pattern(table)),
                       lambda s: F.concat(s, F.lit(" → "), F.coalesce(look_up(table, F.lower(s)), s)))


def terms_found(text: Column, terms: Sequence[str]) -> Column:
    """Listed terms that occur anywhere in the text, any case."""
    return let(F.lower(text), lambda low: F.filter(F.array(*[F.lit(t) for t in terms]),
                                                   lambda t: F.contains(low, F.lower(t))))


def lower_terms(text: Column, terms: Sequence[str]) -> Column:
    """Lower-case each occurrence of the listed terms."""
    return let(text, lambda t: F.when(may_have(t, terms), rewrite(t, "(?iu)" + any_of(terms), span=F.lower)).otherwise(t))


def unify_case(text: Column, table: dict[str, str] = lexicon.CASE_ABBREVIATIONS) -> Column:
    """Where an abbreviation occurs in capitals, raise its lower-case form too, whole words only."""
    lower = {abbr.lower(): abbr for abbr in table}
    pattern = "(?U)" + any_of(lower, r"\b(?:{})\b")

    def raise_known(t: Column) -> Column:
        return rewrite(t, pattern, span=lambda s: let(
            look_up(lower, s), lambda abbr: F.when(F.contains(t, abbr), abbr).otherwise(s)))
    return let(text, raise_known)


def abbreviations_present(text: Column, table: dict[str, str] = lexicon.CASE_ABBREVIATIONS) -> Column:
    entries = [F.struct(F.lit(a).alias("abbr"), F.lit(f).alias("full")) for a, f in table.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.contains(text, e.abbr)))


def compact_units(text: Column, units: Sequence[str] = lexicon.COMPACT_UNITS) -> Column:
    """Lower-case measurements and remove their blanks."""
    pattern = r"(?i)\d+\s*" + any_of(units)
    return rewrite(text, pattern, span=lambda s: F.lower(F.replace(s, F.lit(" "), F.lit(""))))


def unit_mentions(text: Column, units: Sequence[str] = lexicon.COMPACT_UNITS) -> Column:
    """Measurements as written, unit by unit."""
    return F.concat(*[matches(text, rf"(?i)\d+\s*{quote(u)}") for u in units])


def space_by_context(text: Column) -> Column:
    """Blanks around ``.`` and ``,`` always; around ``-`` unless between letters or digits,
    around ``%`` unless between digits, around ``/`` and ``±`` unless each side is a digit or blank."""
    alnum, digit_or_blank = r"[\p{L}\p{N}]", r"(?:(?U)[\d\s])"
    text = F.regexp_replace(text, r"([.,])", " $1 ")
    text = F.regexp_replace(text, rf"(?<!{alnum})-|-(?!{alnum})", " - ")
    text = F.regexp_replace(text, rf"(?<!{digit_or_blank})/|/(?!{digit_or_blank})", " / ")
    text = F.regexp_replace(text, r"(?<!\d)%|%(?!\d)", " % ")
    return F.regexp_replace(text, rf"(?<!{digit_or_blank})±|±(?!{digit_or_blank})", " ± ")


def character_counts(text: Column, chars: Sequence[str] = lexicon.CONTEXT_CHARS) -> Column:
    return F.create_map(*[x for c in chars for x in (F.lit(c), F.regexp_count(text, F.lit(quote(c))).cast("long"))])


def space_after_marks(text: Column) -> Column:
    """Collapse blanks; one blank after ``. , ! ?`` before other text."""
    one = one_blank(text)
    return F.trim(F.regexp_replace(one, r"([.,!?])(?=[^\s.,!?])", "$1 "))


def number_list(text: Column) -> Column:
    """Decimals, integers, ranges and fractions, in that order."""
    found = F.concat(*[matches(text, p) for p in (r"\d+\.\d+", r"\d+", r"\d+\s*-\s*\d+", r"\d+/\d+")])
    return digit_first(text, found, no_strings(text))


def is_kept_token(token: Column, category: str | None = None,
                  kept: Sequence[str] = lexicon.KEPT_WORDS) -> Column:
    """Tokens no stopword list may remove: values, abbreviations, listed words."""
    listed = list(kept) + (lexicon.CATEGORY_KEPT_WORDS.get(category, []) if category else [])
    abbreviation = r"^[A-Z]{2,}$|^[A-Z]{2,}-[A-Z]$|^[A-Z][a-z]+[A-Z]+$"
    return token.rlike(r"^\d") | token.rlike(abbreviation) | F.lower(token).isin(listed)


def is_stopword(token: Column, domain: Sequence[str] = lexicon.DOMAIN_STOPWORDS,
                standard: Sequence[str] = lexicon.STOPWORDS) -> Column:
    return F.lower(token).isin(list(domain) + list(standard))


def token_pattern(spans: dict[str, str] = lexicon.TOKEN_SPANS) -> str:
    return "(?i)" + "|".join(f"(?:{p})" for p in spans.values())


def tokenize_spaced(text: Column, spans: dict[str, str] = lexicon.TOKEN_SPANS,
                    split_pairs: bool = False, split_capitals: bool = False) -> Column:
    """Collapse blanks outside protected spans.

    ``split_pairs`` sets ``X-Y`` apart; ``split_capitals`` puts a blank between capitals
    and a small letter, which also splits capitalized words and is therefore off.
    """
    def gap(g: Column) -> Column:
        if split_pairs:
            g = F.regexp_replace(g, r"([A-Z]-[A-Z])", " $1 ")
        if split_capitals:
            g = F.regexp_replace(g, r"([A-Z]+)([a-z])", "$1 $2")
        return one_blank(g)

    def spaced(t: Column) -> Column:
        cut = rewrite(t, token_pattern(spans), gap=gap)
        # single blanks and nothing to split: whatever the spans, no gap would change
        splits = (["[A-Z]-[A-Z]"] if split_pairs else []) + (["[A-Z][a-z]"] if split_capitals else [])
        found = reduce(lambda a, b: a | b, [t.rlike(x) for x in splits], t.rlike(LONG_WS))
        return F.when(found, cut).otherwise(t)
    return F.trim(let(text, spaced))


