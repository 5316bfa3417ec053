"""Corpus profiling: lengths, outliers, content flags, class balance, missing data, characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from docloom import lexicon
from docloom.functions.scale import hot_join, join_side, top_rows
from docloom.functions.text import BLANKS, WORD, count_of, sentences, unnest, words


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def rule_flags(text: Column, rules: dict[str, str]) -> list[Column]:
    return [flag(text.rlike(p)).alias(name) for name, p in rules.items()]


# ---- length -------------------------------------------------------------------------------

def length_histogram(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Documents per label and length: the small table behind all length statistics.

    Counting first means a label with most of the documents reaches the quantile
    step as one row per distinct length, not as one row per document.
    """
    sized = df.select(F.col(label), F.length(text).cast("long").alias("length"))
    return sized.where("length IS NOT NULL").groupBy(label, "length").agg(F.count("*").alias("n"))


def _moments() -> dict[str, Column]:
    n, x = F.col("n").cast("double"), F.col("length").cast("double")
    total, s1, s2 = F.sum(n), F.sum(n * x), F.sum(n * x * x)
    return {
        "count": F.sum("n"),
        "mean": s1 / total,
        "std": F.when(total > 1, F.sqrt(F.greatest(s2 - s1 * s1 / total, F.lit(0.0)) / (total - 1))),
        "min": F.min("length"),
        "max": F.max("length"),
    }


def length_stats(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Per label: count, mean, sample std, min, max and exact quartiles of the length."""
    m = _moments()
    q = F.percentile("length", [0.25, 0.75], F.col("n"))
    return length_histogram(df, text, label).groupBy(label).agg(
        m["count"].alias("count"), F.round(m["mean"], 2).alias("mean"), F.round(m["std"], 2).alias("std"),
        m["min"].alias("min"), m["max"].alias("max"),
        F.round(F.get(q, 0), 2).alias("q1"), F.round(F.get(q, 1), 2).alias("q3"),
    )


def length_overview(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    m = _moments()
    return length_histogram(df, text, label).agg(m["mean"].alias("mean"), m["std"].alias("std"))


def zscore_outliers(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
                    limit: float = 3.0) -> DataFrame:
    """Documents whose length lies more than ``limit`` sample deviations from the mean."""
    stats = length_overview(df, text, label)
    z = (F.col("length") - stats.select("mean").scalar()) / stats.select("std").scalar()
    sized = df.select(id, label, F.length(text).cast("long").alias("length"))
    return sized.withColumn("z", z).where(F.abs("z") > limit)


def length_fences(df: DataFrame, text: str = "text", label: str = "label", threshold: float = 1.5) -> DataFrame:
    """Per label: Q1, Q3, IQR and upper fence Q3 + threshold * IQR. The lower fence plays no part."""
    quartiles = length_histogram(df, text, label).groupBy(label).agg(
        F.percentile("length", [0.25, 0.75], F.col("n")).alias("q"))
    q1, q3 = F.get("q", 0), F.get("q", 1)
    return quartiles.select(label, q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                            (q3 + threshold * (q3 - q1)).alias("upper_bound"))


def outlier_summary(df: DataFrame, text: str = "text", label: str = "label", threshold: float = 1.5) -> DataFrame:
    """Per label: size, long outliers, their share, longest and shortest, quartiles and fence.

    Works on the length histogram only, the documents are read for nothing else.
    """
    fenced = length_histogram(df, text, label).join(length_fences(df, text, label, threshold), label)
    out = F.col("length") > F.col("upper_bound")
    n_out = F.sum(F.when(out, F.col("n")).otherwise(0))
    return fenced.groupBy(label, "q1", "q3", "iqr", "upper_bound").agg(
        F.sum("n").alias("total_samples"), n_out.alias("num_outliers"),
        (n_out * 100.0 / F.sum("n")).alias("outlier_percentage"),
        F.max(F.when(out, F.col("length"))).alias("max_length"),
        F.min(F.when(out, F.col("length"))).alias("min_length"),
    )


def length_outliers(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
                    threshold: float = 1.5) -> DataFrame:
    """All documents above their label's fence, in one pass over the documents."""
    fences = length_fences(df, text, label, threshold).select(label, "upper_bound")
    sized = df.select(id, label, text, F.length(text).cast("long").alias("text_length"))
    return join_side(sized, fences, label).where(F.col("text_length") > F.col("upper_bound")).drop("upper_bound")


def longest_outliers(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
                     threshold: float = 1.5, k: int = 3) -> DataFrame:
    """The k longest outliers per label with their first 100 characters."""
    shown = length_outliers(df, text, id, label, threshold).select(
        id, label, "text_length", F.substring(text, 1, 100).alias("preview"))
    return top_rows(shown, [label], [F.desc("text_length"), F.asc(id)], k)


# ---- content flags ------------------------------------------------------------------------

def section_flags(df: DataFrame, text: str = "text", id: str = "doc_id",
                  rules: dict[str, str] = lexicon.SECTION_RULES) -> DataFrame:
    return df.select(id, *rule_flags(F.lower(text), rules))


def content_flags(df: DataFrame, text: str = "text", id: str = "doc_id",
                  rules: dict[str, str] = lexicon.CONTENT_RULES) -> DataFrame:
    return df.select(id, *rule_flags(F.lower(text), rules))


def structure_columns(text: Column, rules: dict[str, str] = lexicon.STRUCTURE_RULES) -> list[Column]:
    parts = sentences(text)
    n = F.coalesce(F.size(parts), F.lit(0))
    n_words = F.aggregate(F.transform(parts, lambda s: F.size(words(s))), F.lit(0), lambda a, x: a + x)
    return [
        n.cast("long").alias("num_sentences"),
        (n_words.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))).alias("avg_sentence_length"),
        (count_of(text, "\n\n") + 1).alias("num_paragraphs"),
        *rule_flags(text, rules),
    ]


def content_structure(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Sentences, words per sentence, paragraphs (blank lines + 1), lists, numbers, measurements."""
    return df.select(id, *structure_columns(F.col(text)))


def outlier_patterns(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
                     threshold: float = 1.5, sections: dict[str, str] = lexicon.SECTION_RULES,
                     contents: dict[str, str] = lexicon.CONTENT_RULES) -> DataFrame:
    """Per label, over its long outliers: share of each flag, mean sentences, words per sentence, lists.

    Long form ``(label, aspect, name, value)``, ranked within label and aspect.
    """
    low = F.lower(text)
    flagged = length_outliers(df, text, id, label, threshold).select(
        label, *rule_flags(low, sections), *rule_flags(low, contents), *structure_columns(F.col(text)))
    share = {n: F.avg(n) * 100 for n in [*sections, *contents]}
    wide = flagged.groupBy(label).agg(
        *[c.alias(n) for n, c in share.items()], F.avg("num_sentences").alias("avg_sentences"),
        F.avg("avg_sentence_length").alias("avg_sentence_length"), (F.avg("has_lists") * 100).alias("list_presence"))
    rows = [("section", n) for n in sections] + [("content", n) for n in contents] + \
           [("structure", n) for n in ("avg_sentences", "avg_sentence_length", "list_presence")]
    entries = [F.struct(F.lit(a).alias("aspect"), F.lit(n).alias("name"), F.col(n).alias("value")) for a, n in rows]
    long = wide.select(label, F.inline(F.array(*entries)))
    order = Window.partitionBy(label, "aspect").orderBy(F.desc("value"), F.asc("name"))
    return long.withColumn("rank", F.row_number().over(order))


# ---- class balance ------------------------------------------------------------------------

def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percentage per class; the ratio is taken on the counted table."""
    counted = df.groupBy(label).agg(F.count("*").alias("count"))
    pct = F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counted.select(label, "count", F.round(pct, 2).alias("percentage"))


def distribution_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """Total, classes, largest and smallest class (first label on ties), imbalance ratio."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("label")))
    last = F.min(F.struct(F.col("n").alias("n"), F.col(label).alias("label")))
    return counted.agg(F.sum("n").alias("total_samples"), F.count("*").alias("num_classes"),
                       first.alias("a"), last.alias("b")).select(
        "total_samples", "num_classes",
        F.col("a.label").alias("largest_class"), (-F.col("a.n")).alias("largest_class_count"),
        F.col("b.label").alias("smallest_class"), F.col("b.n").alias("smallest_class_count"),
        (-F.col("a.n").cast("double") / F.col("b.n")).alias("imbalance_ratio"))


def cumulative_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Running percentage by falling class size, over the counted classes."""
    counted = df.groupBy(label).agg(F.count("*").alias("count"))
    whole = Window.partitionBy(F.lit(1))
    run = whole.orderBy(F.desc("count"), F.asc(label)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.select(label, "count",
                          (F.sum("count").over(run) * 100.0 / F.sum("count").over(whole)).alias("cumulative_percentage"))


# ---- missing data and quality -------------------------------------------------------------

def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing cells per column plus the row ``*`` for the whole table, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0))
    cells = [F.struct(F.lit(c).alias("column"), F.col("n").alias("cells"), F.col(c).alias("missing"))
             for c in df.columns]
    cells.append(F.struct(F.lit("*").alias("column"), (F.col("n") * len(df.columns)).alias("cells"),
                          total.alias("missing")))
    long = counts.select(F.inline(F.array(*cells)))
    return long.withColumn("missing_percentage", F.col("missing") * 100.0 / F.nullif("cells", F.lit(0)))


def blank_strings(df: DataFrame) -> DataFrame:
    """Empty and whitespace-only values per string column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[F.struct(F.count_if(F.col(c) == "").alias("empty_strings"),
                               F.count_if(F.col(c).rlike(r"^(?U)\s+$")).alias("whitespace_only")).alias(c)
                      for c in names])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}.empty_strings"), F.col(f"{c}.whitespace_only"))
            for c in names]
    return counts.select(F.inline(F.array(*rows)))


def missing_by_class(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Missing values and their share per class and column."""
    counts = df.groupBy(label).agg(F.count("*").alias("total_samples"),
                                   *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("missing")) for c in columns]
    long = counts.select(label, "total_samples", F.inline(F.array(*rows)))
    return long.withColumn("missing_percentage", F.col("missing") * 100.0 / F.col("total_samples"))


def length_checks(df: DataFrame, text: str = "text", short: int = 50) -> DataFrame:
    size = F.length(text).cast("long")
    return df.select(size.alias("n")).agg(
        F.min("n").alias("min_length"), F.max("n").alias("max_length"), F.avg("n").alias("mean_length"),
        F.count_if(F.col("n") == 0).alias("zero_length"), F.count_if(F.col("n") < short).alias("very_short"))


def issue_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents with unusual characters, runs of blanks, characters beyond ASCII."""
    word = WORD[1:-1]
    return df.agg(F.count_if(F.col(text).rlike(rf"[^{word}\s.,;:\-()]")).alias("invalid_chars"),
                  F.count_if(F.col(text).rlike(r"\s{2,}")).alias("multiple_spaces"),
                  F.count_if(F.col(text).rlike(r"[^\x00-\x7F]")).alias("special_chars"))


def text_digest(text: Column) -> Column:
    """256-bit digest: stands for the text in group keys, so texts themselves are not shuffled."""
    return F.sha2(text, 256)


def duplicate_counts(df: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """Rows beyond the first full copy and texts beyond the first copy.

    Copies are counted where they lie before anything moves, so a text that fills
    a third of the table arrives as one row per task.
    """
    others = [c for c in columns if c != text]
    keyed = df.select(*others, text_digest(F.col(text)).alias("digest"))
    rows = keyed.groupBy("digest", *others).agg(F.count("*").alias("n"))
    texts = rows.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    return texts.agg(F.sum(F.col("n") - F.col("kinds")).alias("exact_duplicates"),
                     F.sum(F.col("n") - 1).alias("description_duplicates"))


def duplicate_rows(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each document that repeats the text of an earlier one, with the id of that first copy."""
    keyed = df.select(id, text_digest(F.col(text)).alias("digest"))
    groups = keyed.groupBy("digest").agg(F.min(id).alias("first_id"), F.count("*").alias("copies"))
    joined = hot_join(keyed, groups.where("copies > 1"), "digest", "copies")
    return joined.where(F.col(id) > F.col("first_id")).select(id, "first_id", "copies")


# ---- special characters -------------------------------------------------------------------

SPECIAL = rf"[^a-zA-Z0-9{BLANKS}]"


def special_characters(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Occurrences per label and special character."""
    chars = unnest(df, [label], F.regexp_extract_all(text, F.lit(SPECIAL), F.lit(0)), "ch")
    return chars.groupBy(label, "ch").agg(F.count("*").alias("n"))


def special_character_totals(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    per_char = special_characters(df, text, label).groupBy("ch").agg(F.sum("n").alias("n"))
    docs = df.agg(F.count("*").alias("docs")).scalar()
    return per_char.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_special_chars"),
                        F.count("*").alias("unique_special_chars")).withColumn(
        "avg_per_document", F.col("total_special_chars").cast("double") / docs)


def common_special_characters(df: DataFrame, text: str = "text", label: str = "label", k: int = 20) -> DataFrame:
    per_char = special_characters(df, text, label).groupBy("ch").agg(F.sum("n").alias("n"))
    return per_char.orderBy(F.desc("n"), F.asc("ch")).limit(k)


def special_characters_by_class(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Total, distinct and mean per document of special characters, per class."""
    docs = df.groupBy(label).agg(F.count("*").alias("docs"))
    chars = special_characters(df, text, label).groupBy(label).agg(
        F.sum("n").alias("total"), F.count("*").alias("unique_special_chars"))
    total = F.coalesce("total", F.lit(0))
    return docs.join(chars, label, "left").select(
        label, total.alias("total_special_chars"),
        F.coalesce("unique_special_chars", F.lit(0)).alias("unique_special_chars"),
        (total.cast("double") / F.col("docs")).alias("avg_per_document"))


def common_special_characters_by_class(df: DataFrame, text: str = "text", label: str = "label",
                                       k: int = 10) -> DataFrame:
    return top_rows(special_characters(df, text, label), [label], [F.desc("n"), F.asc("ch")], k)


def pattern_totals(df: DataFrame, text: str = "text",
                   rules: dict[str, str] = lexicon.COUNTED_PATTERNS) -> DataFrame:
    """Matches of each named pattern over the whole corpus; zero rows stay."""
    sums = df.agg(*[F.coalesce(F.sum(count_of(F.col(text), p)), F.lit(0)).alias(n) for n, p in rules.items()])
    rows = [F.struct(F.lit(n).alias("pattern"), F.col(n).alias("matches")) for n in rules]
    return sums.select(F.inline(F.array(*rows)))


def special_character_density(df: DataFrame, text: str = "text", label: str = "label", k: int = 10) -> DataFrame:
    """Mean count per document of the k commonest special characters, per class; missing is 0."""
    counts = special_characters(df, text, label)
    common = common_special_characters(df, text, label, k)
    top = common.agg(F.sort_array(F.collect_list("ch")).alias("top")).scalar()
    cells = df.groupBy(label).agg(F.count("*").alias("docs")).withColumn("ch", F.explode(top))
    return cells.join(counts, [label, "ch"], "left").select(
        label, "ch", (F.coalesce("n", F.lit(0)).cast("double") / F.col("docs")).alias("density"))


def density_matrix(density: DataFrame, characters: Sequence[str], label: str = "label") -> DataFrame:
    """Pivot of ``special_character_density`` for a known list of characters."""
    return density.groupBy(label).pivot("ch", list(characters)).agg(F.first("density"))
