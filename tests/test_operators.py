"""Scale helpers, splits, features, profiles and metrics against brute force on small tables."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docloom.functions.scale import frequent_join, hash_rank, hot_join, join_side, running_totals, top_rows, write_side
from docloom.functions.text import plain_word_tokens, word_tokens
from docloom.operators import evaluate as e, features as f, profile as p, splits as s, vocabulary as v


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows, two thirds of them under one key; one row with a NULL key."""
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", i * 37 % 101) for i in range(2000)] + [(2000, None, 5)]
    return spark.createDataFrame(rows, "doc_id long, label string, v long").repartition(8).persist()


def test_running_totals_match_brute_force(skewed):
    got = {r["doc_id"]: (r["t"], r["t_total"]) for r in
           running_totals(skewed, ["label"], [F.desc("v"), F.asc("doc_id")], {"t": F.col("v")}).collect()}
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r["label"]].append(r)
    for rows in groups.values():
        total, run = sum(r["v"] for r in rows), 0
        for r in sorted(rows, key=lambda r: (-r["v"], r["doc_id"])):
            run += r["v"]
            assert got[r["doc_id"]] == (run, total)


def test_hash_rank_is_a_permutation_per_group(skewed):
    ranked = hash_rank(skewed, ["label"], "doc_id", 42).collect()
    groups = defaultdict(list)
    for r in ranked:
        groups[r["label"]].append((r["rank"], r["rank_total"]))
    for rows in groups.values():
        assert sorted(x for x, _ in rows) == list(range(1, len(rows) + 1))
        assert {n for _, n in rows} == {len(rows)}
    again = {r["doc_id"]: r["rank"] for r in hash_rank(skewed.repartition(3), ["label"], "doc_id", 42).collect()}
    assert again == {r["doc_id"]: r["rank"] for r in ranked}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_side_joins_equal_join(skewed, how):
    side = skewed.where("label <> 'k3'").groupBy("label").agg(F.sum("v").alias("total"))
    plain = Counter(map(tuple, skewed.join(side, "label", how).select("doc_id", "label", "total").collect()))
    counted = skewed.where("label <> 'k3'").groupBy("label").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    hot = hot_join(skewed, counted, "label", "n", how).select("doc_id", "label", "total").collect()
    assert Counter(map(tuple, hot)) == plain
    assert Counter(map(tuple, join_side(skewed, side, "label", how).select("doc_id", "label", "total").collect())) == plain
    beyond = join_side(skewed, side, "label", how, max_bytes=1).select("doc_id", "label", "total").collect()
    assert Counter(map(tuple, beyond)) == plain


def test_top_rows_limits_before_the_shuffle(skewed):
    top = top_rows(skewed, ["label"], [F.desc("v"), F.asc("doc_id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert max(Counter(r["label"] for r in top.collect()).values()) == 3


def test_split_shares(skewed):
    parts = s.stratified_split(skewed)
    n = Counter((r["label"], r["split"]) for r in parts.collect())
    hot = sum(c for (lab, _), c in n.items() if lab == "hot")
    assert n[("hot", "test")] == math.floor(hot * 0.15 + 0.5)
    assert abs(n[("hot", "val")] - hot * 0.15) <= 1
    assert sum(n.values()) == 2001 and parts.select("doc_id").distinct().count() == 2001


def test_folds_and_batches(skewed):
    folds = s.stratified_folds(skewed)
    sizes = Counter((r["label"], r["fold"]) for r in folds.collect())
    hot = [c for (lab, _), c in sizes.items() if lab == "hot"]
    assert max(hot) - min(hot) <= 1 and len(hot) == 5
    roles = Counter(r["role"] for r in s.expand_folds(s.plain_folds(skewed)).collect())
    assert roles == {"val": 2001, "train": 4 * 2001}
    sizes = Counter(r["batch_id"] for r in s.batches(skewed.select("doc_id"), 32).collect())
    assert len(sizes) == math.ceil(2001 / 32) and sizes[max(sizes)] == 2001 % 32
    ordered = {r["doc_id"]: r["batch_id"] for r in s.batches(skewed.select("doc_id"), 32, shuffle=False).collect()}
    assert all(b == i // 32 for i, b in ordered.items())


def test_labels(skewed, spark):
    known = skewed.where("label IS NOT NULL")
    index = s.label_index(known)
    coded = s.encode_labels(known, index)
    assert {r["label"]: r["label_index"] for r in coded.collect()}["hot"] == 0.0
    back = s.decode_labels(coded, index, "label_index")
    assert back.where("label <> predicted_label").count() == 0
    stranger = spark.createDataFrame([(1, "new")], "doc_id long, label string")
    with pytest.raises(Exception, match="unseen label: new"):
        s.encode_labels(stranger, index).collect()


def test_training_table_checks(spark):
    good = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, label string")
    assert s.validate_training_table(good, ["x"]) is good
    for bad in ([(float("nan"), "a"), (1.0, "b")], [(float("inf"), "a"), (1.0, "b")], [(1.0, "a"), (2.0, "a")],
                [(None, "a"), (1.0, "b")], [(1.0, None), (1.0, "b"), (1.0, "a")]):
        with pytest.raises(ValueError):
            s.validate_training_table(spark.createDataFrame(bad, "x double, label string"), ["x"])
    with pytest.raises(ValueError, match="missing columns"):
        s.validate_training_table(good, ["y"])


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, "red apple red", "a"), (2, "green apple", "a"), (3, "blue Éaume sky", "b"), (4, "", "b"), (5, None, "b"),
            (6, "red red sky", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


def test_tfidf_by_hand(corpus):
    rows = {(r["doc_id"], r["term"]): r["weight"] for r in f.tfidf(corpus, word_tokens(F.col("text")), max_df=1.0).collect()}
    idf = lambda df: math.log((1 + 6) / (1 + df)) + 1
    red, apple = 2 * idf(2), idf(2)
    norm = math.sqrt(red ** 2 + apple ** 2)
    assert rows[(1, "red")] == pytest.approx(red / norm) and rows[(1, "apple")] == pytest.approx(apple / norm)
    assert rows[(2, "apple")] == pytest.approx(1.0) and (2, "green") not in rows
    norms = defaultdict(float)
    for (d, _), w in rows.items():
        norms[d] += w * w
    assert all(x == pytest.approx(1.0) for x in norms.values())


def test_vocabulary_limit_keeps_most_frequent(corpus):
    rows = f.tfidf(corpus, word_tokens(F.col("text")), max_df=1.0, max_features=1).collect()
    assert {r["term"] for r in rows} == {"red"}


def test_plain_words_need_plain_bounds(corpus):
    got = corpus.where("doc_id = 3").select(plain_word_tokens(F.col("text")).alias("t")).first()["t"]
    assert got == ["blue", "sky"]


def test_statistics_of_empty_and_null_text(corpus):
    rows = {r["doc_id"]: r for r in f.statistics(corpus).collect()}
    for d in (4, 5):
        assert rows[d]["word_count"] == 0 and rows[d]["flesch_reading_ease"] == 0 and rows[d]["measurement_density"] == 0
    assert rows[1]["word_count"] == 3 and rows[1]["sentence_count"] == 1


def test_clinical_statistics(spark):
    text = "FVC = 65% ± 5%. ALSFRS-R score decreased from 42 to 38 over 3 months."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = f.statistics(df, category="ALS").first()
    assert (row["percentages_count"], row["ranges_count"], row["plus_minus_count"]) == (2, 1, 0)
    assert row["als_scores_count"] == 2 and row["word_count"] == 15
    found = {r["type"]: r["terms"] for r in f.entities(df, category="ALS").collect()}
    assert found == {"MEASUREMENT": ["score"], "ALS_measurements": ["FVC", "ALSFRS-R"]}


def test_embeddings_ignore_unknown_words(spark, corpus):
    vec = spark.createDataFrame([("red", [1.0, 0.0]), ("apple", [0.0, 1.0])], "word string, vector array<float>")
    out = {r["doc_id"]: r["embedding"] for r in f.document_embeddings(corpus, word_tokens(F.col("text")), vec).collect()}
    assert out[1] == pytest.approx([2 / 3, 1 / 3]) and out[2] == [0.0, 1.0] and out[5] == [0.0, 0.0]
    heavy = {r["doc_id"]: r["embedding"] for r in
             f.document_embeddings(corpus, word_tokens(F.col("text")), vec, weighted_terms=["apple"]).collect()}
    assert heavy[1] == pytest.approx([0.5, 0.5])
    assert f.similar_items(vec, "nothing").count() == 0


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "doc_id long, x double, k double")
    scaler = f.fit_scaler(df, ["x", "k"])
    assert [tuple(r)[1:] for r in f.standard_scale(df, scaler).orderBy("doc_id").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [tuple(r)[1:] for r in f.minmax_scale(df, scaler).orderBy("doc_id").collect()] == [(0.0, 0.0), (1.0, 0.0)]


def test_unknown_feature_family(corpus):
    with pytest.raises(ValueError, match="unknown feature type"):
        f.combine_families({"statistics": f.statistics(corpus)}, ["nothing"])


def test_duplicates_with_one_huge_group(spark):
    rows = [(i, "same", "a" if i % 2 else "b") for i in range(300)] + [(300 + i, f"t{i}", "a") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    assert tuple(p.duplicate_counts(df, ["text", "label"]).first()) == (298, 299)
    dup = p.duplicate_rows(df).collect()
    assert len(dup) == 299 and {r["first_id"] for r in dup} == {0} and {r["copies"] for r in dup} == {300}


def test_zipf_ranks_are_dense(corpus):
    ranks = sorted((r["rank"], r["frequency"]) for r in v.zipf_table(corpus).collect())
    assert [x for x, _ in ranks] == list(range(1, len(ranks) + 1))
    assert [q for _, q in ranks] == sorted((q for _, q in ranks), reverse=True)


@pytest.fixture(scope="module")
def preds(spark):
    rows = [(i, "abc"[i % 3], "abc"[(i * i) % 3], [((i * 7) % 10) / 10, ((i * 3) % 10) / 10, 0.5]) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, label string, prediction string, probability array<double>").persist()


def test_confusion_and_metrics(preds):
    rows = preds.collect()
    cells = {(r["label"], r["prediction"]): r["n"] for r in e.confusion_matrix(preds).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 200
    assert cells == {k: sum((r["label"], r["prediction"]) == k for r in rows) for k in cells}
    right = sum(r["label"] == r["prediction"] for r in rows) / 200
    assert e.accuracy(preds).first()[0] == pytest.approx(right)
    m = e.weighted_metrics(preds).first()
    assert m["accuracy"] == pytest.approx(right) and m["recall"] == pytest.approx(right)
    report = {r["class"]: r for r in e.classification_report(preds).collect()}
    assert report["weighted avg"]["f1"] == pytest.approx(m["f1"]) and report["macro avg"]["support"] == 200
    c = report["c"]
    assert c["precision"] == c["recall"] == c["f1"] == 0  # never predicted
    assert e.confused_pairs(preds).first()["n"] > 0


def test_auc_matches_pair_counting(preds):
    rows = preds.collect()
    auc = {r["class"]: r["auc"] for r in e.roc_auc(e.roc_points(e.class_scores(preds, ["a", "b", "c"]))).collect()}
    for i, k in enumerate("abc"):
        pos = [r["probability"][i] for r in rows if r["label"] == k]
        neg = [r["probability"][i] for r in rows if r["label"] != k]
        pairs = sum((x > y) + 0.5 * (x == y) for x in pos for y in neg) / (len(pos) * len(neg))
        assert auc[k] == pytest.approx(pairs)


def test_bundle_and_summaries(spark, preds):
    bundle = {(r["section"], r["name"]): r["value"] for r in e.evaluation_bundle(preds, ["a", "b", "c"]).collect()}
    assert 0 <= bundle[("auc", "micro")] <= 1 and ("errors", "a->c") in bundle
    folds = spark.createDataFrame([(0, .5, .5, .5, .4), (1, .7, .7, .7, .6)], "fold int, accuracy double, precision double, recall double, f1 double")
    s_ = {r["metric"]: r for r in e.cross_validation_summary(folds).collect()}["f1"]
    assert s_["mean"] == pytest.approx(.5) and s_["std"] == pytest.approx(.1)
    t = e.cross_validation_t_interval(folds).first()
    assert t["ci_high"] - t["mean"] == pytest.approx(12.7062047 * 0.1414213562 / math.sqrt(2), rel=1e-6)
    assert e.best_fold(folds).first()["fold"] == 1


def test_hot_join_spreads_a_key_with_a_third_of_the_rows(spark):
    rows = spark.range(0, 6000, numPartitions=8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("key"))
    side = rows.groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = [r[0] for r in hot_join(rows, side, "key", "n").groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 6000 and max(per_task) < 3 * 6000 / 8


def test_split_column_agrees_with_split_for_missing_labels(spark):
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("label"))
    wide = {r["doc_id"]: r["split"] for r in s.add_split(rows).collect()}
    assert wide == {r["doc_id"]: r["split"] for r in s.stratified_split(rows).collect()}


def test_t_quantiles_for_any_number_of_folds(spark):
    for freedom, want in ((1, 12.7062047), (2, 4.3026527), (4, 2.7764451), (11, 2.2009852), (29, 2.0452296), (200, 1.9718962)):
        assert math.isclose(e.t_quantile(freedom), want, rel_tol=1e-6)
    folds = spark.range(12).select(F.col("id").alias("fold"), (F.col("id") / 10).alias("f1"))
    row = e.cross_validation_t_interval(folds).first()
    assert row["ci_low"] < row["mean"] < row["ci_high"]


def test_frequent_join_leaves_rows_of_frequent_keys_where_they_are(spark):
    keys = [f"k{i}" for i in range(40) for _ in range(400 // (i + 1))]
    rows = write_side(spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string").repartition(6))
    side = write_side(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("key <> 'k3'"))
    want = Counter(map(tuple, rows.join(side, "key").select("id", "key", "n", "top").collect()))
    for most in (0, 1, 5, 1000):
        got = frequent_join(rows, side, "key", "n", most).select("id", "key", "n", "top")
        assert Counter(map(tuple, got.collect())) == want
    near = frequent_join(rows.withColumn("at", F.spark_partition_id()), side, "key", "n", 5).withColumn("now", F.spark_partition_id())
    assert near.where("key IN ('k0', 'k1', 'k2', 'k4', 'k5') AND at <> now").isEmpty()


def test_embeddings_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(f, "SIDE_BYTES", 0)
    monkeypatch.setattr(f, "FREQUENT_VALUES", 4)
    docs = spark.createDataFrame([(1, "aa aa bb cc"), (2, "bb dd"), (3, "zz"), (4, None)], "doc_id long, text string")
    vectors = spark.createDataFrame([("aa", [1.0, 2.0]), ("bb", [3.0, 0.0]), ("cc", [5.0, 4.0]), ("dd", [0.0, 1.0])], "word string, vector array<float>")
    out = f.document_embeddings(docs, word_tokens(F.col("text")), vectors)
    assert {r["doc_id"]: r["embedding"] for r in out.collect()} == {1: [2.5, 2.0], 2: [1.5, 0.5], 3: [0.0, 0.0], 4: [0.0, 0.0]}
