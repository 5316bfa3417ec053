"""Training, ensembles, persistence, streams and experiments."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from docloom.operators import classify as c, features as f, splits as s
from docloom.functions.text import word_tokens
from docloom.plans import ensembles, experiment, prepare
from docloom.plans.stages import ShiftFeatures
from docloom.sources import metrics, tables
from docloom.streaming import scoring


@pytest.fixture(scope="module")
def clusters(spark):
    """Three Gaussian clusters in four dimensions."""
    x = [(F.randn(seed=i) + (F.col("id") % 3 == i % 3).cast("int") * 4) for i in range(4)]
    df = spark.range(240).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("double").alias("label"),
                                 array_to_vector(F.array(*x)).alias("features"))
    return c.with_balanced_weights(df).persist()


def accuracy(model, df):
    return model.transform(df).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


@pytest.mark.parametrize("fit", [
    lambda d: c.logistic_regression(240, max_iter=30).fit(d),
    lambda d: c.random_forest(trees=5, max_depth=4).fit(d),
    lambda d: c.bagging(trees=5, max_samples=0.7, max_depth=4).fit(d),
    lambda d: ensembles.fit_bagged_trees(d, 4, trees=5, max_features=0.75, max_depth=4, weight="weight"),
    lambda d: ensembles.fit_calibrated_svm(d, max_iter=10),
])
def test_models_learn(clusters, fit):
    model = fit(clusters)
    assert accuracy(model, clusters) > 0.85
    p = model.transform(clusters).select(F.expr("1")).count()
    assert p == 240


def test_naive_bayes_needs_the_shift(clusters):
    low = float(c.lowest_value(clusters))
    assert low < 0
    shift = ShiftFeatures(inputCol="features", low=low)
    model = PipelineModel([shift, c.naive_bayes().fit(shift.transform(clusters))])
    assert accuracy(model, clusters) > 0.6


def test_naive_bayes_table_on_text(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    pairs = f.term_counts(d, word_tokens(F.col("text")), carry=["lang"])
    out = c.naive_bayes_score(c.naive_bayes_fit(pairs, d, label="lang"), pairs, d).join(d, "doc_id")
    assert out.select(F.avg((F.col("lang") == F.col("prediction")).cast("double"))).first()[0] > 0.9


def test_predict_checks_width(clusters):
    model = c.logistic_regression(240, max_iter=5).fit(clusters)
    assert c.predict(model, clusters, width=4, classes=3).where("confidence <= 1.0").count() == 240
    with pytest.raises(Exception):
        c.predict(model, clusters, width=7).collect()


def test_stacking(clusters):
    folded = clusters.join(s.stratified_folds(clusters, k=3).select("doc_id", "fold"), "doc_id").persist()
    fits = {"forest": lambda t: c.random_forest(trees=3, max_depth=3).fit(t),
            "logit": lambda t: c.logistic_regression(240, max_iter=10).fit(t)}
    stack = ensembles.fit_stack(folded, fits, lambda t, col: c.logistic_regression(240, C=0.3, max_iter=10, featuresCol=col).fit(t))
    assert accuracy(stack, clusters) > 0.85


def test_early_stop():
    class Fake:
        def __init__(self, score):
            self.score = score
    seen = []

    def fit(x):
        seen.append(x)
        return Fake(x)
    import docloom.operators.classify as mod

    class Evaluator:
        def __init__(self, **_):
            pass

        def evaluate(self, df):
            return df
    Fake.transform = lambda self, _df: self.score
    old, mod.MulticlassClassificationEvaluator = mod.MulticlassClassificationEvaluator, Evaluator
    try:
        best, history = c.fit_until_no_gain([1, 3, 2, 2, 2, 9], fit, None, patience=3)
    finally:
        mod.MulticlassClassificationEvaluator = old
    assert best.score == 3 and len(history) == 5


def test_experiment_logs_and_importances(spark, clusters, tmp_path):
    folder = str(tmp_path / "metrics")
    run = experiment.run_experiment(clusters, lambda t: c.random_forest(trees=3, max_depth=3).fit(t), "exp", folder, k=2,
                                    feature_names=["w", "x", "y", "z"])
    assert run.fold_metrics.count() == 4
    weights = [w for _, w in run.importances]
    assert weights == sorted(weights, reverse=True) and len(weights) == 4
    assert run.final_metrics.count() == 1
    logged = metrics.load_metrics(spark, folder, "exp")
    assert logged.where("metric_type = 'val'").count() == 8 and logged.where("metric_type = 'importance'").count() == 4
    assert logged.where("metric_type = 'final'").count() == 4 and logged.where("metric_type = 'fold_importance'").count() == 8


def test_text_model_saved_and_streamed(spark, sf, tmp_path):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.col("lang").alias("label"))
    prepared, model, index = prepare.prepare(d, max_features=200)
    train = prepared.where("split = 'train'").persist()
    nb = c.naive_bayes(labelCol="label_index").fit(train)
    bundle = PipelineModel([*model.stages, nb])
    path = str(tmp_path / "model")
    tables.save_bundle(bundle, path)
    again = tables.load_bundle(spark, path, ["TextCleaner", "NaiveBayesModel"])
    labels = [r["label"] for r in index.orderBy("label_index").collect()]
    batch = {tuple(r) for r in scoring.score(again, d, labels).select("doc_id", "prediction").collect()}
    assert batch == {tuple(r) for r in scoring.score(bundle, d, labels).select("doc_id", "prediction").collect()}
    source = str(tmp_path / "in")
    d.select("doc_id", "text").write.parquet(source)
    stream = spark.readStream.schema("doc_id long, text string").parquet(source)
    scoring.score_stream(again, stream, labels, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {tuple(r) for r in out.where("status = 'scored'").select("doc_id", "prediction").collect()} == batch
    assert out.count() == d.count()
    blank = spark.createDataFrame([(1, " "), (2, None), (3, "the of and")], "doc_id long, text string")
    scored, rejects = scoring.score_table(again, blank, labels)
    assert scored.count() == 1 and rejects.count() == 2
    with pytest.raises(ValueError, match="lacks"):
        tables.load_bundle(spark, path, ["Missing"])
    with pytest.raises(FileNotFoundError):
        tables.load_bundle(spark, str(tmp_path / "nothing"))


def test_sources(spark, tmp_path):
    rows = [("a \"quoted\"\nline, two", "x"), ("plain", "y"), (None, "z")]
    df = spark.createDataFrame(rows, "description string, label string")
    tables.write_csv(df, str(tmp_path / "csv"))
    assert {tuple(r) for r in tables.read_csv(spark, str(tmp_path / "csv")).collect()} == set(rows)
    with pytest.raises(ValueError, match="missing required columns: label"):
        tables.require_columns(df.drop("label"), ["description", "label"])
    built = []

    def build():
        built.append(1)
        return df
    for _ in range(2):
        assert tables.cached_batches(spark, str(tmp_path), "train", 32, build).count() == 3
    assert built == [1]


def test_weights_keep_rows_without_label(spark):
    rows = spark.range(200).select(F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("label"))
    out = c.with_balanced_weights(rows)
    assert out.count() == 200 and out.where("weight IS NULL").isEmpty()


def test_naive_bayes_with_many_classes(spark):
    docs = spark.range(2002).select(F.col("id").alias("doc_id"), (F.col("id") % 1001).cast("string").alias("label"))
    pairs = docs.select("doc_id", "label", F.concat(F.lit("w"), "label").alias("term"), F.lit(3).alias("tf"))
    model = c.naive_bayes_fit(pairs, docs)
    scored = c.naive_bayes_score(model, pairs, docs).join(docs, "doc_id")
    assert scored.count() == 2002 and scored.where("prediction <> label").isEmpty()


def test_long_texts_are_used_whole(spark):
    long = " ".join(["filler"] * 3000) + " lastword"
    rows = spark.createDataFrame([(i, long if i % 2 else "other text here", "ab"[i % 2]) for i in range(20)], "doc_id long, text string, label string")
    model = prepare.fit_text_features(rows, max_df=1.0)
    assert "lastword" in prepare.vocabulary_of(model)


@pytest.mark.parametrize("name", ["m02_logistic_regression", "m11_confidence"])
def test_registered_logistic_regression_has_the_reference_iterations(spark, sf, monkeypatch, name):
    from registry import models as registered
    from registry.common import QUERIES

    asked, fit = [], registered.c.logistic_regression
    monkeypatch.setattr(registered.c, "logistic_regression", lambda *a, **k: asked.append(k["max_iter"]) or fit(*a, **k))
    QUERIES[name](spark, sf).collect()
    assert asked == [1000]


def test_soft_vote_gives_equal_means_to_the_first_class(spark):
    # mean of b: (1.5 a / n + 0.1) / 2.5, of c: (0.15 + 1.5 a / n - 0.05) / 2.5
    rows = [(n * 100 + a, m, [0.0, x, y, 0.0]) for n in range(3, 40) for a in range(1, n // 3 + 1)
            for m, x, y in (("one", a / n, 0.1), ("two", 0.1, 1.5 * a / n - 0.05))]
    votes = c.soft_vote(spark.createDataFrame(rows, "doc_id long, model string, probability array<double>"), {"one": 1.5, "two": 1.0}, ["a", "b", "c", "d"])
    assert [r[0] for r in votes.select("prediction").distinct().collect()] == ["b"]


def test_naive_bayes_scores_do_not_depend_on_what_is_broadcast(spark, sf, monkeypatch):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    pairs = f.term_counts(d, word_tokens(F.col("text")), carry=["lang"])
    model = c.naive_bayes_fit(pairs, d, label="lang")
    found = []
    for values in (0, 640, c.FREQUENT_VALUES):
        monkeypatch.setattr(c, "FREQUENT_VALUES", values)
        rows = c.naive_bayes_score(model, pairs, d).collect()
        found.append({r["doc_id"]: (r["prediction"], round(r["confidence"], 9)) for r in rows})
    assert found[0] == found[1] == found[2] and len(found[0]) == d.count()
