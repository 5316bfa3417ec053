"""Quality rules (operator 9).

Method: adaptive thresholds from mergeable quantile sketches per language and source. A sketch is a table of counts per
logarithmic bin: bin ``ceil(log_g(1 + x))`` with ``g`` = ``GROWTH`` holds every value with a relative error of at most half a
bin. Sketches merge by adding counts, so each task sends its bins only, a group with a third of all rows arrives as a
few hundred rows per task, and the sketches of a language, and of the whole corpus, are sums of those per source. They
are exact in rank, have no seed and give the same thresholds on every run.

Thresholds follow the sketches in two steps. The corpus sketch gives a range per rule, ``q75 + REACH * (q75 - q25) + tolerance`` at the top (and the
same below ``q25`` where a rule has a lower end), in which values can be ordinary at all. The sketches of each language and source, cut to that
range, then give their own fence: ``q50 + TAIL * (q99 - q50) + slack``, and never beyond the range. So a fence lies where the ordinary documents of its own
group end, and junk cannot raise it, be it a third of a source, as long as it is no quarter of the corpus. Fences of small groups are drawn
towards those of their language, and these towards the corpus: a group of ``n`` documents counts ``n / (n + MIN_GROUP)``. The rules look at
what marks machine junk: symbols per character, duplicate lines, repeated words and mean word length. Sketches hold the documents that pass
the base rule.

Native: DataFrame functions only, no shuffle of texts.

Defined cases: null or blank text has no words and fails the base rule; null ``lang`` or ``source`` are groups of their own;
repeated rows are judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.common import BLANK, blank_text, guarded, let, settle, words_of

MIN_GROUP = 200
GROWTH = 1.01
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REACH, TAIL = 6.0, 1.5
#: rule -> (value per document, tolerance of the range, slack of a fence, whether it has a lower end)
RULES: dict[str, tuple[str, float, float, bool]] = {
    "symbol_ratio": ("n_symbols / greatest(word_chars, 1)", 0.08, 0.01, False),
    "dup_line_ratio": ("n_dup_lines / greatest(n_lines, 1)", 0.50, 0.05, False),
    "repeat_ratio": ("n_repeat_words / greatest(n_words, 1)", 0.35, 0.05, False),
    "mean_word": ("word_chars / greatest(n_words, 1)", 0.25, 0.25, True),
}
#: Values are scaled by this before binning, so that ratios and word lengths use the bins alike.
UNIT = 1000.0


def repeat_words(words: Column) -> Column:
    """Number of words lying in a 3-word window that occurs twice or more in the array, first occurrence included.

    The windows are sorted by hash with their positions; neighbours with the same hash are repeats. Linearithmic, whatever
    the text repeats. A window at ``p`` covers 3 words, or fewer new ones where the next window begins before its end.
    """
    def windows(w):
        n = F.size(w)
        triples = F.arrays_zip(F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, 3, n - 2).alias("c"))
        return F.array_sort(F.transform(triples, lambda t, i: F.struct(F.xxhash64(t["a"], t["b"], t["c"]).alias("h"), i.alias("p"))))

    def repeated(z):
        n = F.size(z)
        before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,p:int>")), F.slice(z, 1, n - 1))
        after = F.concat(F.slice(z, 2, n - 1), F.array(F.lit(None).cast("struct<h:bigint,p:int>")))
        rows = F.arrays_zip(z.alias("z"), before.alias("b"), after.alias("a"))
        hit = F.filter(rows, lambda r: F.coalesce(r["b"]["h"] == r["z"]["h"], F.lit(False)) | F.coalesce(r["a"]["h"] == r["z"]["h"], F.lit(False)))
        return F.array_sort(F.transform(hit, lambda r: r["z"]["p"]))

    def covered(p):
        n = F.size(p)
        gaps = F.arrays_zip(p.alias("p"), F.concat(F.slice(p, 2, n - 1), F.array(F.lit(2**30))).alias("q"))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + F.least(F.lit(3), g["q"] - g["p"]).cast("long"))

    def count(z):
        return let(repeated(z), lambda p: F.when(F.size(p) > 0, covered(p)).otherwise(F.lit(0).cast("long")))

    return F.when(F.size(words) >= 3, let(windows(words), count)).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures of each whole text and ``base_failed``."""
    t = blank_text(text)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(rf"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))
    word_part = let(words_of(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    packed = F.struct(word_part.alias("w"), line_counts.alias("l"),
                      F.char_length(F.regexp_replace(t, f"{BLANK}+", "")).cast("long").alias("c"),
                      (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("s"))
    m = F.col("_m")
    out = docs.withColumn("_m", F.element_at(F.array(packed), 1))
    out = out.withColumns({"n_words": m["w"]["n"], "word_chars": m["c"], "n_symbols": m["s"], "n_lines": m["l"]["n"],
                           "n_dup_lines": m["l"]["n"] - m["l"]["d"], "n_repeat_words": m["w"]["r"]})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.drop("_m").withColumn("base_failed", failed)


def sketches(values: DataFrame) -> DataFrame:
    """Bins of every rule per (lang, source), per lang (source level merged) and overall: ``level, lang, source, rule, bin, n``.

    ``values`` holds ``lang``, ``source`` and a column per rule.
    """
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("x")) for r in RULES]))
    bins = values.select("lang", "source", rules.alias("r")).select(
        "lang", "source", "r.rule", F.ceil(F.log1p(F.col("r.x") * UNIT) / math.log(GROWTH)).cast("int").alias("bin"))
    fine = settle(bins.groupBy("lang", "source", "rule", "bin").agg(F.count(F.lit(1)).alias("n")), "sketch")
    none = F.lit(None).cast("string")
    by_lang = fine.groupBy("lang", "rule", "bin").agg(F.sum("n").alias("n"))
    overall = fine.groupBy("rule", "bin").agg(F.sum("n").alias("n"))
    return (fine.select(F.lit(2).alias("level"), "lang", "source", "rule", "bin", "n")
            .unionByName(by_lang.select(F.lit(1).alias("level"), "lang", none.alias("source"), "rule", "bin", "n"))
            .unionByName(overall.select(F.lit(0).alias("level"), none.alias("lang"), none.alias("source"), "rule", "bin", "n")))


def bin_value() -> Column:
    """Upper end of a bin."""
    return F.expm1(F.col("bin") * math.log(GROWTH)) / UNIT


def quantiles(bins: DataFrame, keys: list[str], **shares: float) -> DataFrame:
    """Quantiles of the sketches per ``keys``, and their number of values ``n_docs``."""
    group = Window.partitionBy(*keys)
    ranked = bins.withColumn("_to", F.sum("n").over(group.orderBy("bin"))).withColumn("_all", F.sum("n").over(group))
    picks = [F.min(F.when(F.col("_to") >= q * F.col("_all"), bin_value())).alias(name) for name, q in shares.items()]
    return ranked.groupBy(*keys).agg(*picks, F.max("_all").alias("n_docs"))


def of_rule(index: int) -> Column:
    """A number of the row's rule."""
    out = F.lit(None).cast("double")
    for rule, numbers in RULES.items():
        out = F.when(F.col("rule") == rule, F.lit(float(numbers[index]))).otherwise(out)
    return out


def fences(bins: DataFrame) -> DataFrame:
    """Per level, lang, source: number of documents ``n_docs`` and the fences of its own sketches, ``<rule>_high`` and ``<rule>_low``."""
    corpus = quantiles(bins.where("level = 0"), ["rule"], q25=0.25, q75=0.75)
    reach = REACH * (F.col("q75") - F.col("q25")) + of_rule(1)
    ends = corpus.select(F.col("rule").alias("_rule"), (F.col("q75") + reach).alias("_top"),
                         F.when(of_rule(3) > 0, F.col("q25") - reach).otherwise(F.lit(-1.0)).alias("_bottom"))
    inside = bins.join(F.broadcast(ends), F.col("rule") == F.col("_rule")).where((bin_value() <= F.col("_top")) & (bin_value() >= F.col("_bottom")))  # a row per rule
    keys = ["level", "lang", "source", "rule"]
    found = quantiles(inside, [*keys, "_top", "_bottom"], q01=0.01, q50=0.5, q99=0.99)
    high = F.least("_top", F.col("q50") + TAIL * (F.col("q99") - F.col("q50")) + of_rule(2))
    low = F.when(F.col("_bottom") < 0, F.lit(-1.0)).otherwise(F.greatest("_bottom", F.col("q50") - TAIL * (F.col("q50") - F.col("q01")) - of_rule(2)))
    per_rule = [F.max(F.when(F.col("rule") == r, F.col(c))).alias(f"{r}_{c[1:]}") for r in RULES for c in ("_high", "_low")]
    return found.withColumn("_high", high).withColumn("_low", low).groupBy("level", "lang", "source").agg(F.max("n_docs").alias("n_docs"), *per_rule)


FENCES = [f"{r}_{end}" for r in RULES for end in ("high", "low")]


def thresholds(values: DataFrame) -> DataFrame:
    """One row per (lang, source): its fences, drawn towards those of its language and of the corpus where it is small; settled."""
    bins = sketches(values)
    f = settle(fences(bins), "fences")
    pick = lambda level, keys: f.where(F.col("level") == level).select(
        *[F.col(k).alias(f"_{k}{level}") for k in keys], F.struct("n_docs", *FENCES).alias(f"_f{level}"))
    groups = bins.where("level = 2").select("lang", "source").distinct()
    same = lambda level, *keys: [F.col(k).eqNullSafe(F.col(f"_{k}{level}")) for k in keys]
    joined = groups.join(pick(2, ["lang", "source"]), same(2, "lang", "source"), "left").join(pick(1, ["lang"]), same(1, "lang"), "left")
    whole = pick(0, []).scalar()

    def drawn(own: Column, parent: Column, name: str) -> Column:
        share = F.col(own)["n_docs"] / (F.col(own)["n_docs"] + MIN_GROUP)
        return F.coalesce(share * F.col(own)[name] + (1 - share) * parent, parent)

    return settle(joined.withColumn("_f0", whole).select("lang", "source", *[drawn("_f2", drawn("_f1", F.col("_f0")[c], c), c).alias(c) for c in FENCES]), "thresholds")


def rule_values(measured: DataFrame) -> DataFrame:
    return measured.withColumns({r: F.expr(f"double({v[0]})") for r, v in RULES.items()})


def with_verdict(valued: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``kept``: false if ``base_failed`` or beyond a fence of the row's group."""
    g = guarded(limits.withColumnsRenamed({"lang": "_lang", "source": "_source"}))
    passed = ~F.col("base_failed")
    for r in RULES:
        passed = passed & F.col(r).between(F.col(f"{r}_low"), F.col(f"{r}_high"))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return valued.join(g, same, "left").withColumn("kept", F.coalesce(passed, F.lit(False)))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base measures, ``base_failed``, the rules' values and ``kept``."""
    narrow = docs.select("doc_id", "lang", "source", "text")
    measured = settle(rule_values(measures(narrow).drop("text")), "measures")
    return with_verdict(measured, thresholds(measured.where("NOT base_failed")))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that ``verdicts`` rejects; columns unchanged.

    Documents are written with their measures and read again: no text is measured twice or shuffled. The base rule is applied to what was written,
    since a filter on a measure before that would compute it a second time.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "lang", "source", "text")
    measured = settle(rule_values(measures(named).drop("text")), "measured-documents").where("NOT base_failed")
    return with_verdict(measured, thresholds(measured.drop("_row"))).where("kept").select("_row.*")
