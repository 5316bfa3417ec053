"""Features: TF-IDF, text statistics, readability, entities, embeddings, scaling."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from docloom import lexicon
from docloom.functions import skipgrams, subwords
from docloom.functions.scale import FREQUENT_VALUES, SIDE_BYTES, frequent_join, hash_rank, plan_bytes, write_side
from docloom.functions.cleaning import needs_digit
from docloom.functions.text import count_of, digit_first, let, ngrams, period_parts, ratio, run_lengths, unnest, word_tokens, words
from docloom.session import ship


# ---- TF-IDF -------------------------------------------------------------------------------

#: Terms whose weights are broadcast.
FREQUENT_TERMS = 100_000


def term_counts(df: DataFrame, tokens: Column, id: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """``(id, carry…, term, tf)``: counted inside each row, so no shuffle is needed."""
    return unnest(df, [id, *carry], run_lengths(tokens), "term", "tf")


def term_vocabulary(pairs: DataFrame, docs: Column, min_df: int = 2, max_df: float = 0.95,
                    max_features: int | None = None) -> DataFrame:
    """``(term, df, cf, idf)`` with smooth idf ln((1 + n) / (1 + df)) + 1.

    Terms in fewer than ``min_df`` or more than ``max_df * n`` documents are dropped;
    ``max_features`` then keeps the most frequent ones (ties by term).
    """
    return limited_vocabulary(pairs.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")), docs, min_df, max_df, max_features)


def limited_vocabulary(counted: DataFrame, docs: Column, min_df: int, max_df: float, max_features: int | None) -> DataFrame:
    """``(term, df, cf)`` within the limits, with ``idf``."""
    vocab = counted.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * docs))
    if max_features is not None:
        vocab = vocab.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    idf = F.log((1.0 + docs) / (1.0 + F.col("df"))) + 1.0
    return vocab.withColumn("idf", idf)


def tfidf(df: DataFrame, tokens: Column, id: str = "doc_id", carry: Sequence[str] = (), min_df: int = 2,
          max_df: float = 0.95, max_features: int | None = None,
          term_weight: Callable[[Column], Column] | None = None) -> DataFrame:
    """TF-IDF in long form ``(id, carry…, term, tf, weight)``, rows of length 1 per document.

    With ``max_features`` the vocabulary is bounded: it goes to every task, weights and norm are computed inside the document's row, and only counts
    per term are shuffled, to find the vocabulary. Without, the frequency of a term is known, so common terms meet their documents by
    broadcast, where these are, and all others in a plain shuffle. ``term_weight`` multiplies the normalized weight and is not normalized again.
    """
    if max_features is not None:
        return bounded_tfidf(df, tokens, id, carry, min_df, max_df, max_features, term_weight)
    pairs = write_side(term_counts(df, tokens, id, carry))
    docs = df.agg(F.count("*").alias("n")).scalar()
    vocab = write_side(term_vocabulary(pairs, docs, min_df, max_df, max_features).select("term", "idf", "df"))
    joined = frequent_join(pairs, vocab, "term", "df", FREQUENT_TERMS).drop("df")
    raw = joined.withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id)))
    weight = F.col("w") / norm
    if term_weight is not None:
        weight = weight * term_weight(F.col("term"))
    return raw.select(id, *carry, "term", "tf", weight.alias("weight"))


def bounded_tfidf(df: DataFrame, tokens: Column, id: str, carry: Sequence[str], min_df: int, max_df: float, max_features: int,
                  term_weight: Callable[[Column], Column] | None = None) -> DataFrame:
    """``tfidf`` for a vocabulary of at most ``max_features`` terms: texts are cut once, and the documents' rows are never shuffled."""
    cut = write_side(df.select(id, *carry, F.coalesce(tokens, F.array().cast("array<string>")).alias("_tokens")))
    vocab = fit_vocabulary(cut, "_tokens", id, min_df, max_df, max_features)
    types = cut.select(id, *carry).schema
    if not vocab:
        return df.sparkSession.createDataFrame([], types.add("term", "string").add("tf", "long").add("weight", "double"))
    terms = F.array(*[F.lit(r["term"]) for r in vocab])
    counted = counts_model([r["term"] for r in vocab], "_tokens", "_counts").transform(cut)
    weighed = ElementwiseProduct(inputCol="_counts", outputCol="_idf", scalingVec=Vectors.dense([r["idf"] for r in vocab])).transform(counted)
    vectors = Normalizer(inputCol="_idf", outputCol="_unit", p=2.0).transform(weighed)
    part = lambda c, name: F.unwrap_udt(c).getField(name)
    cells = F.arrays_zip(part("_counts", "indices").alias("i"), part("_counts", "values").alias("tf"), part("_unit", "values").alias("weight"))
    rows = unnest(vectors, [id, *carry], cells, "i", "tf", "weight").select(id, *carry, F.get(terms, F.col("i")).alias("term"), F.col("tf").cast("long").alias("tf"), "weight")
    return rows.withColumn("weight", F.col("weight") * term_weight(F.col("term"))) if term_weight is not None else rows


def domain_weight(category: str | None = None, weights: dict[str, float] = lexicon.TERM_WEIGHTS,
                  category_terms: dict[str, list[str]] = lexicon.CATEGORY_TERMS,
                  general: Sequence[str] = lexicon.GENERAL_TERMS) -> Callable[[Column], Column]:
    """Weight of a term: of the category, general, measurement-like (has a digit), other; first match wins."""
    def weight(term: Column) -> Column:
        low = F.lower(term)
        return (F.when(low.isin(category_terms.get(category, []) if category else []), weights["category"])
                .when(low.isin(list(general)), weights["general"])
                .when(low.rlike(r"\d"), weights["measurement"])
                .otherwise(weights["other"]))
    return weight


def bigram_tokens(text: Column) -> Column:
    """Word tokens followed by their bigrams."""
    return let(word_tokens(text), lambda t: F.concat(t, ngrams(t, 2)))


def fit_vocabulary(df: DataFrame, tokens: str, id: str = "doc_id", min_df: int = 2, max_df: float = 0.95,
                   max_features: int = 1000) -> list:
    """Vocabulary rows ``(term, idf)`` in falling corpus frequency, for the vector form.

    A vector model keeps its terms on the driver and every executor: ``max_features`` is their number.
    """
    docs = df.agg(F.count("*").alias("n")).scalar()
    kinds = F.array(F.struct(F.lit(0).alias("_new"), F.col(tokens).alias("_terms")), F.struct(F.lit(1).alias("_new"), F.array_distinct(tokens).alias("_terms")))
    rows = unnest(unnest(df, [], kinds, "_new", "_terms"), ["_new"], F.col("_terms"), "term")
    counted = rows.groupBy("term").agg(F.sum("_new").alias("df"), F.count_if(F.col("_new") == 0).alias("cf"))
    vocab = limited_vocabulary(counted, docs, min_df, max_df, max_features)
    return vocab.orderBy(F.desc("cf"), F.asc("term")).select("term", "idf").collect()


def counts_model(terms: Sequence[str], tokens: str, output: str) -> CountVectorizerModel:
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol=tokens, outputCol=output)
    return model.setMinTF(1.0)


# ---- statistics ---------------------------------------------------------------------------

def density_struct(text: Column, category: str | None = None,
                    category_terms: dict[str, list[str]] = lexicon.CATEGORY_TERMS,
                    general: Sequence[str] = lexicon.GENERAL_TERMS) -> Column:
    """The densities as one struct, for which the text is cut into words once."""
    own = category_terms.get(category, []) if category else []

    def measured(w: Column) -> Column:
        n = F.coalesce(F.size(w), F.lit(0))

        def share(test: Callable[[Column], Column]) -> Column:
            return ratio(F.size(F.filter(w, test)), n)

        return F.struct(n.cast("long").alias("length"),
                        share(lambda x: F.lower(x).isin(list(general))).alias("medical_term_density"),
                        share(lambda x: x.rlike(r"\d")).alias("measurement_density"),
                        (share(lambda x: F.lower(x).isin(own)) if own else F.lit(0.0)).alias("disease_term_density"))

    return let(words(text), measured)


def densities(df: DataFrame, text: str = "text", id: str = "doc_id", category: str | None = None,
              **tables) -> DataFrame:
    """Words, and the shares of general terms, measurement-like words and category terms."""
    return df.select(id, density_struct(F.col(text), category, **tables).alias("_densities")).select(id, "_densities.*")


def basic_columns(text: Column) -> list[Column]:
    w, s = words(text), period_parts(text)
    n = F.coalesce(F.size(w), F.lit(0))
    n_s = F.coalesce(F.size(s), F.lit(0))
    letters = F.length(F.array_join(w, ""))
    return [n.cast("long").alias("word_count"), n_s.cast("long").alias("sentence_count"),
            ratio(n, n_s).alias("avg_sentence_length"), ratio(letters, n).alias("avg_word_length")]


def measurement_columns(text: Column, rules: dict[str, str] = lexicon.MEASUREMENT_RULES) -> list[Column]:
    counts = {f"{name}_count": count_of(text, f"(?i){p}") for name, p in rules.items()}
    if needs_digit(list(rules.values())):
        counts = {name: digit_first(text, found, F.lit(0).cast("long")) for name, found in counts.items()}
    total = reduce(lambda a, b: a + b, counts.values())
    return [*[c.alias(n) for n, c in counts.items()],
            ratio(total, F.size(words(text))).alias("measurement_density")]


def category_columns(text: Column, category: str | None,
                     rules: dict[str, dict[str, str]] = lexicon.CATEGORY_COUNT_RULES) -> list[Column]:
    """Counts of the category's patterns; no columns without a known category."""
    return [count_of(text, f"(?i){p}").alias(f"{category.lower()}_{name}_count")
            for name, p in rules.get(category, {}).items()] if category else []


def readability_columns(text: Column) -> list[Column]:
    """Syllables per word (vowel groups + 1), share of words with more than two, Flesch score.

    Counted over the whole text: vowel groups end with their word, and a word has two of them if other letters stand between vowels.
    """
    n, n_s = F.coalesce(F.size(words(text)), F.lit(0)), F.coalesce(F.size(period_parts(text)), F.lit(0))
    total = F.regexp_count(F.lower(text), F.lit("[aeiou]+")) + n
    hard = F.regexp_count(F.lower(text), F.lit(r"(?U)[aeiou][^aeiou\s]++[aeiou]\S*+"))
    flesch = 206.835 - 1.015 * ratio(n, n_s) - 84.6 * ratio(total, n)
    return [ratio(total, n).alias("avg_syllables_per_word"), ratio(hard, n).alias("complex_words_ratio"),
            F.when((n > 0) & (n_s > 0), flesch).otherwise(F.lit(0.0)).alias("flesch_reading_ease")]


def basic_statistics(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    return df.select(id, *basic_columns(F.col(text)))


def measurement_statistics(df: DataFrame, text: str = "text", id: str = "doc_id",
                           rules: dict[str, str] = lexicon.MEASUREMENT_RULES) -> DataFrame:
    return df.select(id, *measurement_columns(F.col(text), rules))


def category_statistics(df: DataFrame, category: str | None, text: str = "text", id: str = "doc_id",
                        rules: dict[str, dict[str, str]] = lexicon.CATEGORY_COUNT_RULES) -> DataFrame:
    return df.select(id, *category_columns(F.col(text), category, rules))


def readability(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    return df.select(id, *readability_columns(F.col(text)))


def statistics(df: DataFrame, text: str = "text", id: str = "doc_id", category: str | None = None,
               clean: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """All statistics of a document; the basic ones look at the cleaned text."""
    t = F.col(text)
    return df.select(id, *basic_columns(clean(t)), *measurement_columns(t), *category_columns(t, category),
                     *readability_columns(t))


def as_vector(df: DataFrame, id: str = "doc_id", output: str = "features") -> DataFrame:
    """All columns but the id as one named vector, in column order."""
    names = [c for c in df.columns if c != id]
    return VectorAssembler(inputCols=names, outputCol=output).transform(df).select(id, output)


# ---- entities -----------------------------------------------------------------------------

def entity_columns(text: Column, category: str | None = None,
                   terms: dict[str, list[str]] = lexicon.ENTITY_TERMS,
                   category_terms: dict[str, dict[str, list[str]]] = lexicon.CATEGORY_ENTITY_TERMS) -> Column:
    """``array<struct<type, terms>>`` of the keywords found in the lower-cased text, per entity type."""
    groups = dict(terms)
    for name, items in category_terms.get(category, {}).items() if category else []:
        groups[f"{category}_{name}"] = items
    low = F.lower(text)
    found = [F.struct(F.lit(g).alias("type"),
                      F.filter(F.array(*[F.lit(t) for t in items]),
                               lambda t: F.contains(low, F.lower(t))).alias("terms"))
             for g, items in groups.items()]
    return F.filter(F.array(*found), lambda e: F.size(e.terms) > 0)


def entities(df: DataFrame, text: str = "text", id: str = "doc_id", category: str | None = None, **tables) -> DataFrame:
    """One row per document and entity type with the keywords found."""
    found = df.select(id, entity_columns(F.col(text), category, **tables).alias("e"))
    return found.select(id, F.inline("e"))


def entity_features(df: DataFrame, text: str = "text", id: str = "doc_id", category: str | None = None,
                    terms: dict[str, list[str]] = lexicon.ENTITY_TERMS, **tables) -> DataFrame:
    """Keywords found, entity types found, keywords per word of each type, category keywords."""
    e = df.select(id, F.size(words(F.col(text))).alias("n"),
                  F.map_from_entries(F.transform(entity_columns(F.col(text), category, terms, **tables),
                                                 lambda x: F.struct(x.type, F.size(x.terms)))).alias("found"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x).cast("long")

    out = [total(F.map_values("found")).alias("total_entities"), F.size("found").cast("long").alias("unique_entity_types")]
    out += [ratio(F.coalesce(F.element_at("found", t), F.lit(0)), F.col("n")).alias(f"{t.lower()}_density")
            for t in terms]
    if category:
        own = F.map_filter("found", lambda k, v: F.startswith(k, F.lit(category)))
        out.append(total(F.map_values(own)).alias("disease_specific_entities"))
    return e.select(id, *out)


# ---- embeddings ---------------------------------------------------------------------------

#: Tokens of a part that one task trains on; with its words' vectors they take some hundred MB.
PART_TOKENS = 4_000_000


class WordVectors:
    """Trained vectors as a table; nothing of them is held on the driver."""

    def __init__(self, table: DataFrame):
        self.table = table

    def getVectors(self) -> DataFrame:
        return self.table.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("vector"))


def words_on_driver(spark, size: int) -> int:
    """Words whose model ``Word2Vec`` can hold in half of the driver's heap: both matrices, once more as they are collected and sent, and the word with its path."""
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // 2 // (16 * size + 900)


def train_word_vectors(df: DataFrame, tokens: str = "tokens", size: int = 100, window: int = 5, min_count: int = 2,
                       seed: int = 42, partitions: int | None = None, **params) -> Word2VecModel | WordVectors:
    """Skip-gram word vectors; one model part per partition, averaged after each iteration.

    A vocabulary beyond ``words_on_driver`` is trained by ``parted_word_vectors``, one pass only; more passes need the driver.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if params.get("maxIter", 1) == 1:
        counted = write_side(unnest(df, [], F.col(tokens), "word").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))
        if counted.count() > words_on_driver(df.sparkSession, size):
            return parted_word_vectors(df, counted, tokens, size, window, seed, parts, params.get("stepSize", 0.025), params.get("maxSentenceLength", 1000))
    return Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, seed=seed, numPartitions=parts,
                    inputCol=tokens, outputCol="embedding", **params).fit(df)


def parted_word_vectors(df: DataFrame, counted: DataFrame, tokens: str, size: int, window: int, seed: int, partitions: int, step: float, longest: int) -> WordVectors:
    """The vectors of the words of ``counted(word, n)`` (``skipgrams``): rows are dealt to ``partitions`` parts, more where a part had over ``PART_TOKENS`` tokens, each part
    is trained in a task, and a word's vectors are averaged over the parts that have it. The driver holds one row per distinct count."""
    ship(df.sparkSession)
    rows = write_side(df.select(F.col(tokens).alias("_tokens"), F.monotonically_increasing_id().alias("_row")).where(F.size("_tokens") > 0))
    total = rows.agg(F.sum(F.size("_tokens").cast("long"))).first()[0] or 0
    parts = max(partitions, -(-total // PART_TOKENS))
    dealt = rows.select(F.pmod(F.col("_row"), F.lit(parts)).cast("long").alias("_part"), "_tokens")
    vocab = write_side(hash_rank(counted, ["n"], "word", seed).select("word", "n", "rank"))
    tree = skipgrams.huffman((r["n"], r["m"]) for r in vocab.groupBy("n").agg(F.count("*").alias("m")).collect())
    own = write_side(unnest(dealt, ["_part"], F.array_distinct("_tokens"), "word").distinct().join(vocab, "word").select("_part", "word", "n", "rank"))
    found = dealt.groupBy("_part").cogroup(own.groupBy("_part")).applyInArrow(
        lambda texts, words: skipgrams.part_vectors(texts, words, tree, size, window, step, longest, seed), "_part long, word string, vector binary")
    ordered = found.repartition("word").sortWithinPartitions("word", "_part").select("word", "vector")
    return WordVectors(write_side(ordered.mapInArrow(lambda batches: skipgrams.means(batches, size), "word string, vector array<float>")))


def document_embeddings(df: DataFrame, tokens: Column, vectors: DataFrame, id: str = "doc_id",
                        size: int | None = None, weighted_terms: Sequence[str] | None = None,
                        weight: float = 2.0) -> DataFrame:
    """Mean of the known words' vectors per document, zeros when none is known.

    ``vectors(word, vector array<float>)``. With ``weighted_terms`` those words count ``weight``
    times. A word is counted inside its document first, and these counts are written. The vectors of frequent words are broadcast, so most of a document's
    sum is made where its counts are; counts of the other words meet their vectors in a shuffle. A vector table whose files are small is broadcast whole.
    """
    counts = write_side(term_counts(df, tokens, id).withColumnRenamed("term", "word"))
    table = write_side(vectors.select("word", "vector"))
    width = size or table.select(F.max(F.size("vector"))).first()[0] or 0
    if plan_bytes(table) <= SIDE_BYTES:
        joined = counts.join(F.broadcast(table), "word")
    else:
        seen = counts.groupBy("word").agg(F.count("*").alias("_n"))
        joined = frequent_join(counts, write_side(table.join(seen, "word")), "word", "_n", FREQUENT_VALUES // max(1, width))
    factor = F.lit(1.0)
    if weighted_terms is not None:
        factor = F.when(F.lower("word").isin(list(weighted_terms)), weight).otherwise(1.0)
    weighed = joined.select(id, "vector", (F.col("tf") * factor).alias("_f"))
    sums = weighed.groupBy(id).agg(F.sum("_f").alias("_f"), *[F.sum(F.get("vector", F.lit(i)).cast("double") * F.col("_f")).alias(f"_{i}") for i in range(width)])
    found = sums.select(id, F.array(*[F.col(f"_{i}") / F.col("_f") for i in range(width)]).cast("array<double>").alias("embedding"))
    return df.select(id).join(found, id, "left").select(
        id, F.coalesce("embedding", F.array_repeat(F.lit(0.0), F.lit(width))).alias("embedding"))


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def similar_items(vectors: DataFrame, key: object, n: int = 10, id: str = "word", vector: str = "vector") -> DataFrame:
    """The n items nearest to ``key`` by cosine; no rows when the key is unknown."""
    found = vectors.where(F.col(id) == key).select(vector).first()
    probe = F.array(*[F.lit(float(x)) for x in found[0]]) if found else F.lit(None).cast("array<double>")
    scored = vectors.where(F.col(id) != key).select(id, cosine(F.col(vector), probe).alias("similarity"))
    return scored.where("similarity IS NOT NULL").orderBy(F.desc("similarity"), F.asc(id)).limit(n)


def subword_vectors(df: DataFrame, tokens: Column, id: str = "doc_id", low: int = 3, high: int = 6,
                    buckets: int = 4096, output: str = "subwords") -> DataFrame:
    """Hashed counts of the character n-grams of bracketed words, which also cover unseen words; none for NULL tokens.

    The buckets are those of ``HashingTF``. A word is cut and hashed once per batch of rows.
    """
    ship(df.sparkSession)
    pieces = df.select(id, tokens.alias("_tokens"))
    schema = T.StructType([pieces.schema[id], T.StructField(output, VectorUDT())])
    return pieces.mapInArrow(lambda batches: subwords.sparse_counts(batches, low, high, buckets, [id, output]), schema)


def combine_families(families: dict[str, DataFrame], wanted: Sequence[str], id: str = "doc_id",
                     output: str = "features") -> DataFrame:
    """Join the chosen feature families (each ``id`` + numeric or vector columns) into one vector."""
    unknown = [w for w in wanted if w not in families]
    if unknown:
        raise ValueError(f"unknown feature type: {', '.join(unknown)}")
    names, joined = [], None
    for family in wanted:
        cols = [c for c in families[family].columns if c != id]
        part = families[family].select(id, *[F.col(c).alias(f"{family}__{c}") for c in cols])
        names += [f"{family}__{c}" for c in cols]
        joined = part if joined is None else joined.join(part, id)
    return VectorAssembler(inputCols=names, outputCol=output).transform(joined).select(id, output)


# ---- scaling ------------------------------------------------------------------------------

def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float, float]]:
    """Mean, population deviation, minimum and maximum per column: one row reaches the driver."""
    row = train.agg(*[F.struct(F.avg(c), F.stddev_pop(c), F.min(c), F.max(c)).alias(c) for c in columns]).first()
    return {c: tuple(float(v) for v in row[c]) for c in columns}


def standard_scale(df: DataFrame, scaler: dict, id: str = "doc_id") -> DataFrame:
    """(x - mean) / std with the population deviation of the fitted rows; constant columns are only centred."""
    return df.select(id, *[((F.col(c) - m) / (s if s > 0 else 1.0)).alias(c) for c, (m, s, _, _) in scaler.items()])


def minmax_scale(df: DataFrame, scaler: dict, id: str = "doc_id") -> DataFrame:
    """(x - min) / (max - min) of the fitted rows, not clipped; constant columns become 0 there."""
    return df.select(id, *[((F.col(c) - lo) / (hi - lo if hi > lo else 1.0)).alias(c)
                           for c, (_, _, lo, hi) in scaler.items()])
