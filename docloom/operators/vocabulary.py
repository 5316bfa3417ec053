"""Vocabulary, word frequencies, n-grams and class profiles.

All counts start from one ``(label, [n,] term)`` aggregate with map-side
combining; everything ranked afterwards is at most one row per distinct term.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window

from docloom import lexicon
from docloom.functions.scale import join_side, running_totals, top_rows, write_side
from docloom.functions.text import ngram_text, ngram_words, plain_word_tokens, unnest, vocabulary_tokens
from docloom.operators.features import tfidf


def vocabulary(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
               stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    return df.select(id, label, vocabulary_tokens(F.col(text), stopwords).alias("tokens"))


def label_words(df: DataFrame, text: str = "text", label: str = "label",
                stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """Occurrences per label and word."""
    tokens = unnest(df, [label], vocabulary_tokens(F.col(text), stopwords), "word")
    return tokens.groupBy(label, "word").agg(F.count("*").alias("n"))


def label_vocabulary(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Per label: distinct words, all words, words per document (empty documents count)."""
    docs = df.groupBy(label).agg(F.count("*").alias("docs"))
    found = label_words(df, text, label).groupBy(label).agg(
        F.count("*").alias("unique_words"), F.sum("n").alias("total_words"))
    return docs.join(found, label, "left").select(
        label, F.coalesce("unique_words", F.lit(0)).alias("unique_words"),
        F.coalesce("total_words", F.lit(0)).alias("total_words"),
        (F.coalesce("total_words", F.lit(0)).cast("double") / F.col("docs")).alias("avg_words_per_doc"))


def top_words(df: DataFrame, text: str = "text", label: str = "label", k: int = 10) -> DataFrame:
    return top_rows(label_words(df, text, label), [label], [F.desc("n"), F.asc("word")], k)


def word_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    words = unnest(df, [], vocabulary_tokens(F.col(text)), "word")
    return words.groupBy("word").agg(F.count("*").alias("frequency"))


def zipf_table(df: DataFrame, text: str = "text") -> DataFrame:
    """Word, frequency, rank and both base-10 logarithms; ties ranked by word."""
    ranked = running_totals(word_frequency(df, text), [], [F.desc("frequency"), F.asc("word")], {"rank": F.lit(1)})
    return ranked.select("word", "frequency", F.col("rank").cast("long"),
                         F.log10("frequency").alias("log_freq"), F.log10("rank").alias("log_rank"))


def vocabulary_overview(df: DataFrame, text: str = "text") -> DataFrame:
    return word_frequency(df, text).agg(
        F.count("*").alias("unique_words"), F.sum("frequency").alias("total_words"),
        F.avg("frequency").alias("avg_frequency"))


# ---- class profiles -----------------------------------------------------------------------

def class_term_scores(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label",
                      min_df: int = 10, stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """Per label and term that the label has: mean TF-IDF in the class, and that less the mean in all other classes.

    Documents without the term count as 0. Next to both stand ``total`` (the term's weight in all classes), ``docs`` and ``all_docs``; every class
    has one row without a term, so that classes without any are known. Written once, as profiles read it more than once.
    """
    weights = tfidf(df, plain_word_tokens(F.col(text), stopwords), id=id, carry=[label], min_df=min_df, max_df=1.0)
    sums = weights.groupBy(label, "term").agg(F.sum("weight").alias("own"))
    sums = sums.withColumn("total", F.sum("own").over(Window.partitionBy("term")))  # at most a row per class
    sizes = df.groupBy(label).agg(F.count("*").alias("docs"))
    sizes = sizes.withColumn("all_docs", df.agg(F.count("*")).scalar())
    rows = join_side(sums, sizes, label).unionByName(sizes.select(label, F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("own"),
                                                                  F.lit(0.0).alias("total"), "docs", "all_docs"))
    others = F.col("all_docs") - F.col("docs")
    rest = F.when(others > 0, (F.col("total") - F.col("own")) / others).otherwise(F.lit(0.0))
    mean = F.col("own") / F.col("docs")
    return write_side(rows.select(label, "term", mean.alias("score"), (mean - rest).alias("distinctiveness"), "total", "docs", "all_docs"))


def class_profile(scores: DataFrame, label: str = "label", k: int = 20, by: str = "score") -> DataFrame:
    """Top terms per class by mean score or by distinctiveness (rounded, so ties are stable).

    A term that a class lacks scores 0 there and is distinctive by 0 at most. So only classes with fewer than ``k`` positive terms look at
    the terms they lack, which is known from one count per class.
    """
    value = F.round(by, 6)
    found = scores.where("term IS NOT NULL").select(label, "term", value.alias(by))
    short = write_side(scores.groupBy(label).agg(F.count_if((value > 0) & F.col("term").isNotNull()).alias("good"), F.max("docs").alias("docs"),
                                                 F.max("all_docs").alias("all_docs")).where(F.col("good") < k))
    if not short.isEmpty():
        terms = scores.where("term IS NOT NULL").groupBy("term").agg(F.max("total").alias("total"))
        wanted = short.agg(F.collect_list(F.struct(F.col(label), "docs", "all_docs"))).scalar()
        cells = terms.select("term", "total", F.inline(wanted))
        others = F.col("all_docs") - F.col("docs")
        rest = F.when(others > 0, F.col("total") / others).otherwise(F.lit(0.0))
        lacking = cells.select(label, "term", F.round(F.lit(0.0) - (rest if by == "distinctiveness" else F.lit(0.0)), 6).alias(by))
        known = found.select(F.col(label).alias("_label"), F.col("term").alias("_term"))
        lacking = lacking.join(known, F.col(label).eqNullSafe(F.col("_label")) & (F.col("term") == F.col("_term")), "left_anti")
        found = found.unionByName(lacking)
    return top_rows(found, [label], [F.desc(by), F.asc("term")], k)


def vocabulary_overlap(profile: DataFrame, label: str = "label") -> DataFrame:
    """Jaccard similarity of the top-term sets for every pair of classes, diagonal 1."""
    sets = profile.groupBy(label).agg(F.collect_set("term").alias("terms"))
    classes = sets.agg(F.collect_list(F.struct(F.col(label).alias("label"), "terms")).alias("classes"))
    pairs = classes.select("classes", F.explode("classes").alias("a")).select("a", F.explode("classes").alias("b"))
    common = F.size(F.array_intersect("a.terms", "b.terms")).cast("double")
    return pairs.select(F.col("a.label").alias("label_a"), F.col("b.label").alias("label_b"),
                        (common / F.size(F.array_union("a.terms", "b.terms"))).alias("overlap"))


# ---- n-grams ------------------------------------------------------------------------------

def clean_for_ngrams(df: DataFrame, text: str = "text", id: str = "doc_id", label: str = "label") -> DataFrame:
    return df.select(id, label, ngram_text(F.col(text)).alias("text"))


#: Classes whose counts of an n-gram stand side by side in its row; of more classes, each counts in a row of its own first.
WIDE_CLASSES = 16


def ngram_rows(df: DataFrame, text: str = "text", label: str = "label", max_n: int = 3,
               stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """``(label, gram)``: a row per word and size, made next to the word; stopwords are dropped for single words only."""
    tokens = df.select(label, ngram_words(F.col(text)).alias("_words"))
    at = tokens.select(label, "_words", F.posexplode_outer("_words").alias("_i", "_word"))

    def of_size(n: int) -> Column:
        """NULL where the text ends too early."""
        if n == 1:
            return F.when(~F.col("_word").isin(list(stopwords)), F.col("_word"))
        return F.concat("_word", *[c for k in range(1, n) for c in (F.lit(" "), F.get("_words", F.col("_i") + F.lit(k)))])

    return unnest(at, [label], F.array(*[of_size(n) for n in range(1, max_n + 1)]), "gram")


def ngram_classes(df: DataFrame, text: str = "text", label: str = "label", max_n: int = 3,
                  stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """One row per n-gram: ``(n, gram, classes, cells)`` with the number of classes that have it and a ``(label, count)`` of each, zeros among them.

    The n-gram alone is the key, so that one shuffle counts it for all classes; its words have no blanks, so they give ``n``.
    """
    rows = ngram_rows(df, text, label, max_n, stopwords)
    labels = [r[0] for r in df.select(label).distinct().limit(WIDE_CLASSES + 1).collect()]
    if 0 < len(labels) <= WIDE_CLASSES:
        counts = [F.col(f"_{i}") for i in range(len(labels))]
        counted = rows.groupBy("gram").agg(*[F.count_if(F.col(label).eqNullSafe(F.lit(x))).alias(f"_{i}") for i, x in enumerate(labels)])
        kind = df.schema[label].dataType
        cells = F.array(*[F.struct(F.lit(x).cast(kind).alias(label), c.alias("count")) for x, c in zip(labels, counts)])
        classes = reduce(lambda a, b: a + b, [F.when(c > 0, 1).otherwise(0) for c in counts])
    else:
        counted = rows.groupBy(label, "gram").agg(F.count("*").alias("count"))
        counted = counted.groupBy("gram").agg(F.collect_list(F.struct(label, "count")).alias("_cells"))
        cells, classes = F.col("_cells"), F.size("_cells")
    blanks = F.length("gram") - F.length(F.replace(F.col("gram"), F.lit(" ")))
    return counted.select((blanks + 1).alias("n"), "gram", classes.alias("classes"), cells.alias("cells"))


def ngram_counts(df: DataFrame, text: str = "text", label: str = "label", max_n: int = 3,
                 stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """Occurrences per label, n and n-gram; stopwords are dropped for n = 1 only."""
    found = ngram_classes(df, text, label, max_n, stopwords).select("n", "gram", F.inline("cells"))
    return found.where("count > 0").select(label, "n", "gram", "count")


def top_ngrams(counts: DataFrame, label: str = "label", k: int = 10) -> DataFrame:
    return top_rows(counts, [label, "n"], [F.desc("count"), F.asc("gram")], k)


def distinctive_ngrams(df: DataFrame, text: str = "text", label: str = "label", max_n: int = 3,
                       stopwords: Sequence[str] = lexicon.STOPWORDS) -> DataFrame:
    """Score count * ln(classes / classes containing the gram), both known where the gram is counted."""
    classes = df.select(F.count_distinct(label)).scalar()
    found = ngram_classes(df, text, label, max_n, stopwords).select("n", "gram", "classes", F.inline("cells")).where("count > 0")
    score = F.col("count") * F.log(classes.cast("double") / F.col("classes"))
    return found.select(label, "n", "gram", "count", score.alias("score"))
