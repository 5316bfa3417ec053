"""Cross-validated search over several models and their grids, as a job that can be stopped and goes on where it was."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators import classify, evaluate
from docloom.plans import ensembles
from docloom.plans.scaling import MINMAX, VectorScaler
from docloom.sources.tables import exists

SCORES = "model string, setting string, fold int, accuracy double, precision double, recall double, f1 double, seconds double"
#: The grids of the five models. MLlib has one solver for a multinomial model, and grows trees to 30 levels.
GRIDS: dict[str, dict[str, list]] = {
    "naive_bayes": {"alpha": [0.1, 0.5, 1.0, 2.0], "fit_prior": [True, False]},
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "max_iter": [2000]},
    "svm": {"C": [0.1, 1.0, 10.0]},
    "random_forest": {"trees": [100, 200], "min_leaf": [1, 2]},
    "bagging": {"trees": [50, 100], "max_samples": [0.5, 0.7, 1.0], "max_features": [0.5, 0.7, 1.0]},
}


@dataclass(frozen=True)
class Candidate:
    """A model with one point of its grid."""

    model: str
    setting: dict
    fit: Callable[[DataFrame], Model]

    @property
    def name(self) -> str:
        return json.dumps(self.setting, sort_keys=True)

    def folder(self, fold: int) -> str:
        digest = hashlib.sha256(f"{self.model}:{self.name}".encode()).hexdigest()[:16]
        return f"{self.model}-{digest}-{fold}"


def points(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def fit_naive_bayes(train: DataFrame, alpha: float = 1.0, fit_prior: bool = True, label: str = "label", features: str = "features") -> Model:
    """Multinomial on min-max scaled features. Without priors the prediction divides by them, as MLlib always learns them; probabilities keep them."""
    scaler = VectorScaler(inputCol=features, outputCol="_scaled", kind=MINMAX, clip=True).fit(train)
    model = classify.naive_bayes(alpha, featuresCol="_scaled", labelCol=label).fit(scaler.transform(train))
    if not fit_prior:
        model = model.setThresholds([math.exp(x) for x in model.pi.toArray()])
    return PipelineModel([scaler, model])


def scaled_fit(fit: Callable[[DataFrame, str], Model], features: str = "features") -> Callable[[DataFrame], Model]:
    """``fit(rows, column)`` on features scaled by the training rows, as one model."""
    def run(train: DataFrame) -> Model:
        scaler = VectorScaler(inputCol=features, outputCol="_scaled").fit(train)
        return PipelineModel([scaler, fit(scaler.transform(train), "_scaled")])
    return run


def candidates(models: Sequence[str], n_features: int, grids: dict[str, dict[str, list]] = GRIDS, label: str = "label", features: str = "features",
               id: str = "doc_id", weight: str = "weight", parallelism: int = 4) -> list[Candidate]:
    """All points of the named models. Rows need ``id``, ``label``, ``features`` and the class ``weight``."""
    def fit(model: str, s: dict) -> Callable[[DataFrame], Model]:
        if model == "naive_bayes":
            return lambda t: fit_naive_bayes(t, s["alpha"], s["fit_prior"], label, features)
        if model == "logistic_regression":
            return scaled_fit(lambda t, c: classify.logistic_regression(max(1, t.count()), s["C"], s["max_iter"], weight, featuresCol=c, labelCol=label).fit(t), features)
        if model == "svm":
            return scaled_fit(lambda t, c: ensembles.fit_calibrated_svm(t, s["C"], weight=weight, label=label, features=c, id=id, parallelism=parallelism), features)
        if model == "random_forest":
            return scaled_fit(lambda t, c: classify.random_forest(s["trees"], min_leaf=s["min_leaf"], weight=weight, featuresCol=c, labelCol=label).fit(t), features)
        if model == "bagging":
            return scaled_fit(lambda t, c: ensembles.fit_bagged_trees(t, n_features, s["trees"], s["max_samples"], s["max_features"], label=label, features=c, id=id,
                                                                     parallelism=parallelism), features)
        raise ValueError(f"unknown model: {model}")

    return [Candidate(m, s, fit(m, s)) for m in models for s in points(grids[m])]


def search(folded: DataFrame, tried: Sequence[Candidate], folder: str, k: int = 5, fold: str = "fold", label: str = "label",
           parallelism: int = 2) -> DataFrame:
    """Scores of every candidate on every fold (``SCORES``), kept in ``folder``.

    One (candidate, fold) is fitted, scored and dropped at a time per worker of the pool, so the driver holds one model per worker. Its scores are
    a finished table of their own; a run that broke off goes on with what is missing. Failures are raised after all others are done.
    """
    spark = folded.sparkSession
    base = f"{folder.rstrip('/')}/scores"
    todo = [(c, i) for c in tried for i in range(k) if not exists(spark, f"{base}/{c.folder(i)}/_SUCCESS")]
    failures: list[str] = []

    def run(c: Candidate, i: int) -> None:
        try:
            start = time.time()
            model = c.fit(folded.where(F.col(fold) != i))
            found = evaluate.weighted_metrics(model.transform(folded.where(F.col(fold) == i)), label=label).collect()
            scores = [float(found[0][m]) if found else 0.0 for m in evaluate.METRICS]
            row = spark.createDataFrame([(c.model, c.name, i, *scores, time.time() - start)], SCORES)
            row.coalesce(1).write.mode("overwrite").parquet(f"{base}/{c.folder(i)}")
        except Exception as e:  # noqa: BLE001  the other candidates go on
            failures.append(f"{c.model} {c.name} fold {i}: {e}")

    kept = folded.persist()
    try:
        ensembles.in_pool([lambda c=c, i=i: run(c, i) for c, i in todo], parallelism)
    finally:
        kept.unpersist()
    if failures:
        raise RuntimeError("; ".join(failures))
    return load_scores(spark, folder)


def load_scores(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCORES).parquet(f"{folder.rstrip('/')}/scores/*")


def ranking(scores: DataFrame) -> DataFrame:
    """Mean and deviation of the scores per candidate, and its rank within its model by weighted F1."""
    per = scores.groupBy("model", "setting").agg(
        F.count("*").alias("folds"), *[F.avg(m).alias(m) for m in evaluate.METRICS], F.stddev_pop("f1").alias("f1_std"))
    best = per.groupBy("model").agg(F.min(F.struct((-F.col("f1")).alias("f"), "setting")).alias("b"))
    return per.join(F.broadcast(best), "model").withColumn("best", F.col("setting") == F.col("b.setting")).drop("b")  # one row per model


def refit(scores: DataFrame, tried: Sequence[Candidate], train: DataFrame) -> dict[str, tuple[dict, Model]]:
    """The best setting of each model by mean weighted F1, and the model fitted with it on all rows."""
    best = {r["model"]: r["setting"] for r in ranking(scores).where("best").collect()}
    return {c.model: (c.setting, c.fit(train)) for c in tried if best.get(c.model) == c.name}
