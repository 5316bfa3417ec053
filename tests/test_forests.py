"""Forests whose nodes stay in tables."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from docloom.operators import classify as c
from docloom.plans import ensembles, forests, growing


@pytest.fixture(scope="module")
def noisy(spark):
    """Two informative dimensions of five, a third of the labels at random: trees become deep."""
    x = [F.randn(seed=i) * 2 + (F.col("id") % 3 == i).cast("int") * (2.5 if i < 2 else 0) for i in range(5)]
    label = F.when(F.rand(9) < 0.3, F.floor(F.rand(10) * 3)).otherwise(F.col("id") % 3).cast("double")
    return spark.range(1200).select(F.col("id").alias("doc_id"), label.alias("label"), array_to_vector(F.array(*x)).alias("features")).coalesce(3).persist()


def scores(model, df):
    return model.transform(df).orderBy("doc_id").select(vector_to_array("probability"), "prediction").collect()


def accuracy(model, df):
    return model.transform(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_nodes_split_over_all_tasks_make_the_same_trees(noisy, monkeypatch):
    """All features at every node, so that the trees do not depend on draws of features."""
    fit = lambda: c.bagging(trees=4, max_samples=0.8).fit(noisy)
    whole = fit()
    monkeypatch.setattr(forests, "LOCAL_ROWS", 60)
    monkeypatch.setattr(forests, "PASS_CELLS", 5 * 32 * 4 * 3)
    cut = fit()
    assert whole.parts.count() == 4 and cut.parts.count() > 40
    assert scores(cut, noisy) == scores(whole, noisy)
    assert np.allclose(cut.featureImportances.toArray(), whole.featureImportances.toArray())


def test_deep_trees_are_as_good_as_those_of_mllib(noisy):
    train, held = noisy.where("doc_id % 4 > 0"), noisy.where("doc_id % 4 = 0")
    own = c.random_forest(trees=30, weight=None).fit(train)
    other = RandomForestClassifier(numTrees=30, maxDepth=12, seed=1).fit(train)
    assert abs(accuracy(own, held) - accuracy(other, held)) < 0.06
    a, b = own.featureImportances.toArray(), other.featureImportances.toArray()
    assert abs(a.sum() - 1) < 1e-9 and set(np.argsort(a)[-2:]) == set(np.argsort(b)[-2:]) == {0, 1}


def test_the_driver_holds_no_subtrees(noisy):
    model = c.random_forest(trees=6, weight=None).fit(noisy)
    nodes = model.parts.agg(F.sum(F.length("cut"))).first()[0]
    assert nodes > 1000 and all(len(t["feature"]) == 1 for t in model.state()["tops"])


def test_scoring_more_rows_than_were_fitted(noisy, monkeypatch):
    model = c.bagging(trees=3).fit(noisy.where("doc_id < 300"))
    before = scores(model, noisy)
    monkeypatch.setattr(forests, "LOCAL_ROWS", 100)
    assert scores(model, noisy) == before and len(before) == 1200


def brute(x, y, w, classes):
    gini = lambda m: 1 - sum((w[m & (y == k)].sum() / w[m].sum()) ** 2 for k in range(classes))
    every = np.ones(len(y), bool)
    gains = {}
    for f in range(x.shape[1]):
        for cut in range(growing.BINS - 1):
            low = x[:, f] <= cut
            if low.any() and not low.all():
                gains[f, cut] = gini(every) - (w[low].sum() * gini(low) + w[~low].sum() * gini(~low)) / w.sum()
    return max(gains.values())


def test_splits_are_the_best_ones():
    draw = np.random.default_rng(3)
    x, y, w = draw.integers(0, 32, (80, 3)).astype(np.uint8), draw.integers(0, 3, 80), draw.random(80) + 0.5
    feature, cut, left, shares, importance = growing.grow(x, y, w, np.ones(80), 3, np.arange(3), 3, 1, 30, draw)
    assert importance.sum() > 0 and abs(growing.grow(x, y, w, np.ones(80), 3, np.arange(3), 3, 1, 1, draw)[4].sum() / w.sum() - brute(x, y, w, 3)) < 1e-12
    leaf = growing.leaf_of(x, feature, cut, left)
    assert (shares[leaf].argmax(1) == y).all()  # pure leaves
    few = growing.grow(x, y, w, np.ones(80), 3, np.arange(3), 3, 7, 30, draw)
    assert np.bincount(growing.leaf_of(x, *few[:3])).min() >= 7
    assert len(growing.grow(x, y, w, np.ones(80), 3, np.arange(3), 3, 1, 2, draw)[0]) <= 7


def test_odd_rows(spark, noisy):
    one = noisy.withColumn("label", F.lit(0.0))
    assert {tuple(r[0]) for r in scores(c.bagging(trees=2).fit(one), one)} == {(1.0,)}
    with pytest.raises(ValueError):
        c.random_forest(weight=None).fit(noisy.limit(0))
    # no row is drawn for some trees
    tiny = c.bagging(trees=40).fit(noisy.limit(1))
    assert tiny.transform(noisy.limit(5)).count() == 5
    empty = ensembles.fit_bagged_trees(noisy, 5, 2).transform(noisy.limit(0))
    assert empty.count() == 0 and empty.columns == [*noisy.columns, "probability", "prediction"]
