"""Scaling stages, saved ensembles, calibration, resumable search and experiment."""

import json
import math
from functools import partial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from docloom.operators import classify as c, evaluate as e, splits as s
from docloom.plans import ensembles, experiment, machines, prepare, tuning
from docloom.plans.scaling import MINMAX, VectorScaler
from docloom.plans.stages import feature_names
from docloom.sources import metrics, tables


@pytest.fixture(scope="module")
def clusters(spark):
    """Three overlapping Gaussian clusters in four dimensions."""
    x = [(F.randn(seed=i) * 2 + (F.col("id") % 3 == i % 3).cast("int") * 2.5) for i in range(4)]
    df = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("double").alias("label"),
                                 array_to_vector(F.array(*x)).alias("features"))
    return c.with_balanced_weights(df.coalesce(2)).persist()


def rows_of(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), ["doc_id", "features"])


def dense(df, column="scaled"):
    return np.array([r[0] for r in df.orderBy("doc_id").select(vector_to_array(column)).collect()])


WIDE = [Vectors.sparse(40, {0: 1.0 + i, 3: 2.0 * (i % 5), 7 + i % 30: 1.5}) for i in range(50)]


@pytest.mark.parametrize("kind,centre", [("standard", False), ("standard", True), ("minmax", False)])
def test_scaling_as_by_hand(spark, tmp_path, kind, centre):
    df = rows_of(spark, WIDE)
    model = PipelineModel([VectorScaler(kind=kind, centre=centre).fit(df)])
    x = np.array([v.toArray() for v in WIDE])
    spread = x.max(axis=0) - x.min(axis=0) if kind == "minmax" else x.std(axis=0)
    wanted = (x - (x.min(axis=0) if kind == "minmax" else x.mean(axis=0) if centre else 0)) / np.where(spread > 0, spread, 1)
    assert np.allclose(dense(model.transform(df)), wanted, atol=1e-12)
    path = str(tmp_path / "m")
    tables.save_bundle(model, path)
    assert np.array_equal(dense(tables.load_bundle(spark, path, ["VectorScalerModel"]).transform(df)), dense(model.transform(df)))


def test_scaling_keeps_sparse_vectors_sparse(spark):
    df = rows_of(spark, WIDE)
    for kind in ("standard", MINMAX):
        shifted = rows_of(spark, [Vectors.sparse(40, {k: v for k, v in zip(w.indices, w.values) if k}) for w in WIDE])
        out = VectorScaler(kind=kind).fit(shifted).transform(shifted).first()["scaled"]
        assert isinstance(out, SparseVector) and out.numNonzeros() <= 3
    with pytest.raises(ValueError):
        VectorScaler().fit(df.limit(0))
    with pytest.raises(ValueError):
        VectorScaler(kind="other").fit(df)


def test_scaling_with_nulls_and_names(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 5.0])), (2, None), (3, Vectors.dense([3.0, 5.0]))], ["doc_id", "features"])
    out = VectorScaler(outputCol="features", centre=True).fit(df).transform(df).orderBy("doc_id")
    assert out.columns == ["doc_id", "features"]
    assert [r["features"] if r["features"] is None else list(r["features"].toArray()) for r in out.collect()] == [[-1.0, 0.0], None, [1.0, 0.0]]


def test_clipped_scaling_stays_in_range(spark):
    """Rows beyond the fitted range, which naive Bayes would reject."""
    fitted, new = rows_of(spark, [Vectors.dense([1.0, 0.0]), Vectors.dense([3.0, 4.0])]), rows_of(spark, [Vectors.dense([0.0, 5.0]), Vectors.dense([2.0, -1.0])])
    assert dense(VectorScaler(kind=MINMAX).fit(fitted).transform(new)).tolist() == [[-0.5, 1.25], [0.5, -0.25]]
    assert dense(VectorScaler(kind=MINMAX, clip=True).fit(fitted).transform(new)).tolist() == [[0.0, 1.0], [0.5, 0.0]]


def test_mean_as_intercept_shift(clusters):
    plain, centred = (VectorScaler(centre=x).fit(clusters) for x in (False, True))
    fit = lambda m: LogisticRegression(featuresCol="scaled", family="multinomial", regParam=0.01, standardization=False, maxIter=300, tol=1e-12).fit(m.transform(clusters))
    a, b = fit(plain), fit(centred)
    assert np.allclose(a.coefficientMatrix.toArray(), b.coefficientMatrix.toArray(), atol=1e-4)
    moved = a.interceptVector.toArray() + plain.intercept_shift(a.coefficientMatrix.toArray())
    assert np.allclose(moved - moved.mean(), b.interceptVector.toArray() - b.interceptVector.toArray().mean(), atol=1e-3)


def test_scaled_model_streams(spark, clusters, tmp_path):
    scaler = VectorScaler(centre=True).fit(clusters)
    model = PipelineModel([scaler, c.logistic_regression(300, max_iter=20, featuresCol="scaled").fit(scaler.transform(clusters))])
    path = str(tmp_path / "in")
    clusters.select("doc_id", "features").write.parquet(path)
    stream = model.transform(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)).select("doc_id", "prediction")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {tuple(r) for r in model.transform(clusters).select("doc_id", "prediction").collect()}


def scores(model, df):
    return [(r["doc_id"], r["prediction"], [round(x, 9) for x in r["p"]]) for r in
            model.transform(df).select("doc_id", "prediction", vector_to_array("probability").alias("p")).orderBy("doc_id").collect()]


def test_ensembles_saved_and_reloaded(spark, clusters, tmp_path):
    folded = clusters.join(s.stratified_folds(clusters, k=2).select("doc_id", "fold"), "doc_id").persist()
    bag = lambda t: ensembles.fit_bagged_trees(t, 4, 3, 0.8, 0.5, max_depth=2, weight="weight")
    svm = lambda t: ensembles.fit_calibrated_svm(t, max_iter=2, folds=2)
    stack = ensembles.fit_stack(folded, {"bag": bag, "svm": svm}, lambda t, col: c.logistic_regression(300, C=0.3, max_iter=10, featuresCol=col).fit(t), k=2)
    for k, model in enumerate([stack, stack.bases["bag"], stack.bases["svm"]]):
        path = str(tmp_path / f"m{k}")
        tables.save_bundle(PipelineModel([model]), path)
        again = tables.load_bundle(spark, path, [type(model).__name__])
        assert scores(again, clusters) == scores(model, clusters)
        assert again.stages[0].uid == model.uid
    assert all(abs(sum(p) - 1) < 1e-6 for _, _, p in scores(stack, clusters))


def test_bootstrap_counts_are_poisson(spark):
    counts = spark.range(20000).select(ensembles.bootstrap_count(F.col("id"), 3, 0.7, 1).alias("n")).groupBy("n").count().collect()
    share = {r["n"]: r["count"] / 20000 for r in counts}
    for k in range(4):
        assert abs(share[k] - math.exp(-0.7) * 0.7 ** k / math.factorial(k)) < 0.015


def test_bagged_trees_only_use_their_features(clusters):
    model = ensembles.fit_bagged_trees(clusters, 4, 6, 1.0, 0.25, max_depth=4)
    used = [set(np.flatnonzero(t.featureImportances.toArray())) for t in model.trees]
    assert all(len(u) <= 1 for u in used) and len(set().union(*used)) > 1


def log_loss(df, margins, sigmoids):
    p = [1.0 / (1.0 + F.exp(-(F.lit(a) * F.get(margins, F.lit(i)) + F.lit(b)))) for i, (a, b) in enumerate(sigmoids)]
    total = sum(p, F.lit(0.0))
    own = F.get(F.array(*[x / total for x in p]), F.col("label").cast("int"))
    return df.select(F.avg(-F.log(F.greatest(own, F.lit(1e-12))))).first()[0]


def test_sigmoids_of_unseen_margins_are_better(spark):
    """With as many features as rows the machines separate what they are trained on; only unseen margins say how far they can be trusted."""
    draw = np.random.default_rng(8)
    rows = [(i, float(i % 2), Vectors.dense(draw.standard_normal(40) + 0.35 * (i % 2))) for i in range(240)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features"]).coalesce(1)
    train, held = df.where("doc_id < 80").persist(), df.where("doc_id >= 80").persist()
    model = ensembles.fit_calibrated_svm(train, C=1000.0, max_iter=12, weight=None, folds=2)
    seen = ensembles.fit_sigmoids(ensembles.with_margins(train, model.machines, "features"), 2)
    scored = ensembles.with_margins(held, model.machines, "features")
    assert log_loss(scored, "_margins", model.sigmoids) < log_loss(scored, "_margins", seen)


def test_machines_of_many_classes_with_little_to_go_by(spark):
    """Ten classes that hardly differ: a machine that is not balanced calls every row one of the others, and all rows get the class with the largest offset."""
    draw = np.random.default_rng(5)
    y = draw.integers(0, 10, 1500)
    x = draw.standard_normal((1500, 8)) + 0.4 * (np.arange(8) == (y % 8)[:, None])
    df = c.with_balanced_weights(spark.createDataFrame([(i, float(k), Vectors.dense(v)) for i, (k, v) in enumerate(zip(y, x))], ["doc_id", "label", "features"]).coalesce(2)).persist()
    machines = ensembles.fit_machines(df, 10, 1 / 1500, 20, "weight", "label", "features", 4)
    model = ensembles.CalibratedSvm(machines, [(1.0, 0.0)] * 10)
    rows = model.transform(df).select("label", "prediction").collect()
    assert len({r["prediction"] for r in rows}) == 10
    assert sum(r["label"] == r["prediction"] for r in rows) > 1.2 * np.bincount(y).max()


def test_sigmoids_minimize_the_loss(spark):
    draw = np.random.default_rng(1)
    x = draw.standard_normal(400)
    y = (draw.random(400) < 1 / (1 + np.exp(-(1.7 * x - 0.4)))).astype(float)
    df = spark.createDataFrame([(float(b), [float(-a), float(a)]) for a, b in zip(x, y)], "label double, _margins array<double>")
    (_, _), (a, b) = ensembles.fit_sigmoids(df, 2)
    p = y.sum()
    t = np.where(y > 0, (p + 1) / (p + 2), 1 / (400 - p + 2))
    loss = lambda a, b: np.mean(np.logaddexp(0, a * x + b) - t * (a * x + b))
    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-12 for da in (-1e-3, 0, 1e-3) for db in (-1e-3, 0, 1e-3))


def test_search_goes_on_where_it_stopped(spark, clusters, tmp_path):
    folded = clusters.join(s.stratified_folds(clusters, k=3).select("doc_id", "fold"), "doc_id").persist()
    fitted = []

    def candidate(name, reg, broken=False):
        def fit(train):
            if broken and len(fitted) >= 2:
                raise RuntimeError("stopped")
            fitted.append((name, reg))
            return c.logistic_regression(200, C=reg, max_iter=5).fit(train)
        return tuning.Candidate(name, {"C": reg}, fit)

    folder = str(tmp_path / "search")
    with pytest.raises(RuntimeError, match="stopped"):
        tuning.search(folded, [candidate("a", 1.0, True), candidate("a", 0.001, True)], folder, k=3, parallelism=1)
    assert len(fitted) == 2 and tuning.load_scores(spark, folder).count() == 2
    tried = [candidate("a", 1.0), candidate("a", 0.001)]
    scores_ = tuning.search(folded, tried, folder, k=3, parallelism=2)
    assert len(fitted) == 6 and scores_.count() == 6
    assert tuning.search(folded, tried, folder, k=3).count() == 6 and len(fitted) == 6
    ranked = tuning.ranking(scores_).collect()
    assert len(ranked) == 2 and sum(r["best"] for r in ranked) == 1
    best = max(ranked, key=lambda r: r["f1"])
    setting, model = tuning.refit(scores_, tried, clusters)["a"]
    assert setting == json.loads(best["setting"]) and model.numClasses == 3


def test_grids_have_the_points_of_the_five_models(clusters, monkeypatch):
    sizes = {m: len(tuning.points(g)) for m, g in tuning.GRIDS.items()}
    assert sizes == {"naive_bayes": 8, "logistic_regression": 3, "svm": 3, "random_forest": 4, "bagging": 18}
    small = {"naive_bayes": {"alpha": [1.0], "fit_prior": [True, False]}, "logistic_regression": {"C": [1.0], "max_iter": [20]}, "svm": {"C": [1.0]},
             "random_forest": {"trees": [2], "min_leaf": [1]}, "bagging": {"trees": [2], "max_samples": [0.5], "max_features": [0.5]}}
    monkeypatch.setattr(tuning.classify, "random_forest", partial(c.random_forest, max_depth=3))
    monkeypatch.setattr(tuning.ensembles, "fit_bagged_trees", partial(ensembles.fit_bagged_trees, max_depth=3))
    monkeypatch.setattr(tuning.ensembles, "fit_calibrated_svm", partial(ensembles.fit_calibrated_svm, max_iter=3, folds=2))
    for x in tuning.candidates(list(small), 4, small):
        out = x.fit(clusters).transform(clusters)
        assert out.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.45, x.model


def test_experiment_goes_on_where_it_stopped(spark, clusters, tmp_path):
    fitted = []

    def fit(train, most=99):
        if len(fitted) >= most:
            raise RuntimeError("stopped")
        fitted.append(train.count())
        return c.logistic_regression(300, max_iter=10).fit(train)

    folder = str(tmp_path / "log")
    with pytest.raises(RuntimeError):
        experiment.run_experiment(clusters, lambda t: fit(t, 2), "x", folder, k=4)
    assert not tables.exists(spark, folder)
    run = experiment.run_experiment(clusters, fit, "x", folder, k=4, feature_names=["a", "b", "c", "d"])
    assert len(fitted) == 5 and run.fold_metrics.count() == 8 and run.final_metrics.count() == 1
    again = experiment.run_experiment(clusters, fit, "x", folder, k=4, feature_names=["a", "b", "c", "d"])
    assert len(fitted) == 5 and type(again.model) is type(run.model)
    assert scores(again.model, clusters) == scores(run.model, clusters)
    assert metrics.load_metrics(spark, folder, "x").where("metric_type = 'val'").count() == 16


def test_default_features_have_names_and_values(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.col("lang").alias("label"))
    prepared, model, _index = prepare.prepare(d, max_features=50, statistics=True)
    names = feature_names(prepared)
    assert len(names) == 50 + 4 + 13 and names[50:55] == ["density:length", "density:medical_term_density", "density:measurement_density",
                                                          "density:disease_term_density", "statistics:word_count"]
    assert names[-1] == "statistics:flesch_reading_ease"
    got = {r["doc_id"]: list(r["features"].toArray()) for r in prepared.collect()}
    new = {r["doc_id"]: list(r["features"].toArray()) for r in model.transform(d).select("doc_id", "features").collect()}
    assert got == new  # cleaned once and cleaned by the model


def test_bundle_reads_its_predictions_once(spark):
    rows = [(i, "ab"[i % 2], "ab"[(i // 3) % 2], [0.5 + (i % 7) / 20, 0.5 - (i % 7) / 20], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, label string, prediction string, probability array<double>, fold int")
    out = e.evaluation_bundle(df, ["a", "b"], fold="fold")
    found = {(r["section"], r["name"]): r["value"] for r in out.collect()}
    wrong = [r for r in rows if r[1] != r[2]]
    assert found["counts", "misclassified_count"] == len(wrong) and sum(k[0] == "case" for k in found) == len(wrong)
    assert found["overall", "accuracy"] == pytest.approx(1 - len(wrong) / 60) and ("cross_validation", "f1:ci_low") in found
    tally = e.evaluation_tally(df, ["a", "b"], "fold")
    assert tally._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_report_of_a_fit(clusters):
    parts = {"train": clusters.where("doc_id % 3 <> 0 OR doc_id < 150"), "val": clusters.where("doc_id >= 150")}
    _model, report = c.fit_with_report(lambda t: c.random_forest(trees=3, max_depth=3).fit(t), parts, ["a", "b", "c", "d"])
    found = {(r["section"], r["name"]): r["value"] for r in report.collect()}
    assert ("metrics", "f1:val") in found and found["time", "seconds"] > 0 and sum(k[0] == "importance" for k in found) == 4


def test_machines_that_step_together_are_as_good_as_one_by_one(spark, clusters):
    """All classes and folds in one pass a step: the loss is that of MLlib's machines, in far fewer jobs."""
    rows = clusters.select("doc_id", "label", "features", "weight", vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"),
                           F.col("weight").alias("w"), (F.col("doc_id") % 2).cast("int").alias("fold")).persist()
    together = machines.fit_together(rows, 3, [0, -1], [0.02, 0.01], 25, True)

    def loss(m, kept, k, ridge):
        y = np.array([1.0 if r["y"] == k else -1.0 for r in kept])
        w = np.array([r["w"] for r in kept])
        w = np.where(y > 0, w * w.sum() / (2 * w[y > 0].sum()), w * w.sum() / (2 * w[y < 0].sum()))
        z = 1 - y * (np.array([r["x"] for r in kept]) @ m[:-1] + m[-1])
        return (w * np.maximum(z, 0)).sum() / w.sum() + ridge / 2 * (m[:-1] ** 2).sum()

    for s_, (out, ridge) in enumerate([(0, 0.02), (-1, 0.01)]):
        seen = rows.where(F.col("fold") != out)
        kept = seen.collect()
        for k, m in enumerate(ensembles.fit_machines(seen, 3, ridge, 25, "weight", "label", "features", 3)):
            assert loss(together[s_, k], kept, k, ridge) <= 1.02 * loss(np.array([*m.coefficients, m.intercept]), kept, k, ridge)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    ensembles.fit_calibrated_svm(clusters, max_iter=5, folds=2)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before < 100


def test_the_registered_stack_has_its_whole_sizes(monkeypatch):
    from registry import QUERIES, models
    made = {}
    monkeypatch.setattr(models, "folded_rows", lambda spark, sf, k: type("Rows", (), {"count": lambda self: 9})())
    monkeypatch.setattr(models, "verdicts", lambda model, df: model)
    monkeypatch.setattr(models.c, "random_forest", lambda trees=100, **options: type("Forest", (), {"fit": lambda self, t: made.update(forest=trees)})())
    monkeypatch.setattr(ensembles, "fit_bagged_trees", lambda t, n, trees, *sizes, **options: made.update(bagging=trees))
    monkeypatch.setattr(ensembles, "fit_calibrated_svm", lambda t, C, max_iter, **options: made.update(svm=max_iter))
    monkeypatch.setattr(ensembles, "fit_stack", lambda train, fits, final: [fit(train) for fit in fits.values()])
    QUERIES["m16_stacking"](None, "")
    assert made == {"bagging": 50, "forest": 100, "svm": 100}
