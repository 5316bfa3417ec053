"""Narrow TF-IDF, sparse class profiles, prepared sets, feature names, naive Bayes with many classes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from docloom.functions import skipgrams, subwords
from docloom.functions.text import word_tokens
from docloom.operators import classify as c, features as f, splits as s, vocabulary as v
from docloom.plans.stages import feature_names
from docloom.sources import tables


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, " ".join(f"word{(i * k) % 13}" for k in range(1, 9)), "ab"[i % 2]) for i in range(40)] + [(90, "", "a"), (91, None, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4)


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bounded_tfidf_equals_the_joined_one(texts):
    """The same weights, with nothing shuffled behind the vocabulary."""
    tokens = word_tokens(F.col("text"))
    rounded = lambda df: sorted((r["doc_id"], r["label"], r["term"], r["tf"], round(r["weight"], 9)) for r in df.collect())
    bounded = f.tfidf(texts, tokens, carry=["label"], max_df=1.0, max_features=1000)
    assert rounded(bounded) == rounded(f.tfidf(texts, tokens, carry=["label"], max_df=1.0))
    assert exchanges(bounded) == 0
    assert f.tfidf(texts, tokens, min_df=1000, max_features=5).count() == 0


def profile_by_hand(rows, k, by, min_df=2):
    """All terms for all classes, as the definition says."""
    docs = {i: Counter(t.split()) for i, t, _ in rows}
    df = Counter(w for d in docs.values() for w in d)
    idf = {w: math.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items() if n >= min_df}
    weight = {}
    for i, d in docs.items():
        raw = {w: n * idf[w] for w, n in d.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        weight[i] = {w: x / norm for w, x in raw.items()}
    classes = {lab for _, _, lab in rows}
    out = []
    for lab in classes:
        own = [i for i, _, x in rows if x == lab]
        rest = [i for i, _, x in rows if x != lab]
        mean = lambda ids, w: sum(weight[i].get(w, 0) for i in ids) / len(ids) if ids else 0.0
        scored = {w: mean(own, w) - (mean(rest, w) if by == "distinctiveness" else 0) for w in idf}
        ranked = sorted(((-round(x, 6) + 0.0, w) for w, x in scored.items()))[:k]
        out += [(lab, w, r + 1) for r, (_, w) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("by", ["score", "distinctiveness"])
def test_profiles_of_classes_with_few_terms(spark, by):
    """A class with two terms, and one without any, are filled up with terms they lack."""
    rows = [(i, " ".join(f"w{chr(97 + (i * k) % 11)}x" for k in range(1, 6)), "abc"[i % 3]) for i in range(45)]
    rows += [(100 + i, "wbx wax", "few") for i in range(3)] + [(200, "", "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = v.class_profile(v.class_term_scores(df, min_df=2, stopwords=[]), k=9, by=by)
    assert sorted((r["label"], r["term"], r["rank"]) for r in got.collect()) == profile_by_hand(rows, 9, by)


def test_prepared_set_round_trip(spark, tmp_path):
    rows = spark.range(30).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("label"),
                                  F.when(F.col("id") < 20, "train").otherwise("test").alias("split"),
                                  array_to_vector(F.array(F.col("id") * 1.0, F.lit(2.0))).alias("features"))
    labels, path = s.label_index(rows), str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        tables.load_prepared_set(spark, path)
    tables.save_prepared_set(rows, labels, path, ["count", "two"], ["statistics"])
    again, known, manifest = tables.load_prepared_set(spark, path, "test")
    assert feature_names(again) == ["count", "two"] and again.count() == 10 and manifest["feature_types"] == ["statistics"]
    assert {tuple(r) for r in known.collect()} == {("x", 0.0), ("y", 1.0)}
    assert {(r["doc_id"], r["features"][0]) for r in again.collect()} == {(i, float(i)) for i in range(20, 30)}


def test_naive_bayes_probabilities_by_hand(spark):
    docs = [(1, "a", "x y"), (2, "a", "x x z"), (3, "b", "y y"), (4, "c", "q"), (5, "b", "")]
    rows = spark.createDataFrame(docs, "doc_id long, label string, text string")
    pairs = f.term_counts(rows, word_tokens(F.col("text"), 1), carry=["label"])
    got = {r["doc_id"]: r["probability"] for r in c.naive_bayes_score(c.naive_bayes_fit(pairs, rows), pairs, rows).collect()}
    terms = {w for _, _, t in docs for w in t.split()}
    per = {lab: Counter(w for _, x, t in docs if x == lab for w in t.split()) for lab in "abc"}
    for i, _, t in docs:
        score = [math.log(sum(x == lab for _, x, _ in docs) / 5)
                 + sum(math.log((per[lab][w] + 1) / (sum(per[lab].values()) + len(terms))) for w in t.split()) for lab in "abc"]
        e = [math.exp(x - max(score)) for x in score]
        assert got[i] == pytest.approx([x / sum(e) for x in e])


def grams_by_hand(rows, stopwords):
    found = Counter()
    for label, text in rows:
        t = re.findall("[a-z]+", (text or "").lower())
        found.update((label, 1, w) for w in t if w not in stopwords)
        found.update((label, n, " ".join(t[i:i + n])) for n in (2, 3) for i in range(len(t) - n + 1))
    return found


@pytest.mark.parametrize("classes", [3, 40])
def test_ngrams_are_counted_in_one_shuffle(spark, classes):
    """Few classes side by side, many one after the other; NULL is a class, texts without words have no n-grams."""
    rows = [(f"c{i % classes}", f"The cat{i % 5}-sat,\non a mat{i % 3} the end") for i in range(120)] + [(None, "on a mat"), ("c0", None), ("c1", "12 "), ("c1", "one")]
    df = spark.createDataFrame(rows, "label string, text string").repartition(3)
    found = grams_by_hand(rows, ["the", "on", "a"])
    counts = v.ngram_counts(df, stopwords=["the", "on", "a"])
    assert {(r["label"], r["n"], r["gram"]): r["count"] for r in counts.collect()} == dict(found)
    have = Counter((n, g) for _, n, g in found)
    scored = v.distinctive_ngrams(df, stopwords=["the", "on", "a"])
    assert {(r["label"], r["n"], r["gram"]): (r["count"], round(r["score"], 9)) for r in scored.collect()} == \
        {k: (c, round(c * math.log(classes / have[k[1:]]), 9)) for k, c in found.items()}
    if classes == 3:
        grams = v.ngram_classes(df.localCheckpoint())
        assert str(grams._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning(gram") == 1
    assert v.ngram_counts(df.limit(0)).count() == 0


def test_subword_vectors_equal_hashed_ngrams(spark):
    """The buckets of HashingTF, also beyond ASCII; NULL tokens have none; each word is cut once."""
    rows = [(1, ["the", "théâtre", "the"]), (2, []), (3, None), (4, ["a", "über", "𝔘nicode", "日本語"]), (5, [f"w{i % 7}x" for i in range(250_000)])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    found = {r["doc_id"]: r["subwords"] for r in f.subword_vectors(df, F.col("tokens"), buckets=512).collect()}
    pieces = [(i, [w[k:k + n] for t in tokens or [] for w in [f"<{t}>"] for n in range(3, 7) for k in range(len(w) - n + 1)]) for i, tokens in rows]
    hashed = HashingTF(numFeatures=512, inputCol="g", outputCol="v").transform(spark.createDataFrame(pieces, "doc_id long, g array<string>"))
    assert found == {r["doc_id"]: r["v"] for r in hashed.collect()}
    assert subwords.word_buckets(pa.array(["a", "the", ""]), 3, 6, 512)[1].tolist() == [1, 6, 0]


def test_densities_cut_the_text_once(texts):
    plan = f.densities(texts, category="X", category_terms={"X": ["word1"]})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1


def test_vocabulary_of_vectors_equals_the_table(texts):
    """Documents and occurrences of a term, counted without sorting the documents' tokens."""
    rows = texts.select("doc_id", word_tokens(F.concat("text", F.lit(" word1 word1"))).alias("tokens"))
    counted = f.term_vocabulary(f.term_counts(rows, F.col("tokens")), F.lit(42), 2, 0.95, 9).orderBy(F.desc("cf"), "term")
    assert [tuple(r) for r in f.fit_vocabulary(rows, "tokens", max_features=9)] == [(r["term"], r["idf"]) for r in counted.collect()]


def test_huffman_runs_are_a_shortest_code():
    draw = random.Random(5)
    for _ in range(60):
        counts = sorted(draw.choice([2, 2, 2, 3, 5, 8, 13, 40]) for _ in range(draw.randrange(1, 60)))
        nodes, codes = skipgrams.paths(skipgrams.huffman(Counter(counts).items()), np.arange(len(counts)))
        lengths, heap, cost = (nodes >= 0).sum(1), list(counts), 0
        while len(heap) > 1:
            heap.sort()
            cost, heap = cost + heap[0] + heap[1], [heap[0] + heap[1], *heap[2:]]
        assert (lengths * np.array(counts)).sum() == cost and len(np.unique(nodes[nodes >= 0])) == len(counts) - 1
        assert len({tuple(zip(n[:k], c[:k])) for n, c, k in zip(nodes.tolist(), codes.tolist(), lengths)}) == len(counts)


def test_word_vectors_without_the_vocabulary_on_the_driver(spark, monkeypatch):
    draw = random.Random(2)
    kinds = [[f"{k}{i}" for i in range(12)] for k in "ab"]
    rows = [(i, draw.choices(kinds[i % 2], k=30) + (["rare"] if i == 0 else [])) for i in range(1200)]
    rows += [(1, None), (1, []), (2, ["b1"] * 7)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    known = {w for k in kinds for w in k}
    monkeypatch.setattr(f, "Word2Vec", None)
    monkeypatch.setattr(f, "words_on_driver", lambda spark, size: 0)
    model = f.train_word_vectors(df, size=20, partitions=3, stepSize=0.2)
    found = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert set(found) == known and all(len(v) == 20 and np.isfinite(v).all() for v in found.values())
    near = {w: max((x for x in found if x != w), key=lambda x: found[x] @ found[w] / np.linalg.norm(found[x])) for w in found}
    assert all(w[0] == x[0] for w, x in near.items())


def test_means_of_words_over_batches():
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 1.0), ("c", 2.0), ("c", 6.0), ("d", 4.0)]
    for size in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_pydict({"word": [w for w, _ in part], "vector": [np.full(2, x, np.float32).tobytes() for _, x in part]})
                   for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        got = [(w, v) for b in skipgrams.means(iter(batches), 2) for w, v in zip(b.column("word").to_pylist(), b.column("vector").to_pylist())]
        assert got == [("a", [2.0, 2.0]), ("b", [5.0, 5.0]), ("c", [3.0, 3.0]), ("d", [4.0, 4.0])]
