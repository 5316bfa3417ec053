"""Training and scoring: naive Bayes as aggregations, MLlib models, votes, early stopping, importances."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.scale import FREQUENT_VALUES, frequent_join, join_side, settle, write_side
from docloom.functions.text import let
from docloom.operators.evaluate import weighted_metrics
from docloom.plans.forests import Forest


# ---- class weights ------------------------------------------------------------------------

def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (k * n_c) per class."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = counted.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counted.select(label, (whole.getField("n") / (whole.getField("k") * F.col("n"))).alias("weight"))


def with_balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Every row with the weight of its class; NULL is a class of its own."""
    return join_side(df, balanced_weights(df, label), label, "left")


# ---- multinomial naive Bayes in long form --------------------------------------------------

@dataclass(frozen=True)
class NaiveBayesTable:
    """Classes with log prior and log denominator; per term its count ``cf`` and, for the classes that have it, what it adds to their score.

    ``gains`` holds (class, log(n + alpha) - log(alpha)); a class without the term gets ``log(alpha)`` alone.
    """

    classes: list[str]
    priors: list[float]
    denominators: list[float]
    log_alpha: float
    terms: DataFrame


def naive_bayes_fit(pairs: DataFrame, docs: DataFrame, alpha: float = 1.0, fit_prior: bool = True,
                    label: str = "label") -> NaiveBayesTable:
    """Fit on ``pairs(id, label, term, tf)`` of the documents ``docs(id, label)``.

    Counted by (term, label) once and folded into one row per term, so any number of classes costs no more than its
    pairs; only class totals reach the driver.
    """
    if alpha <= 0:
        raise ValueError("alpha must be positive")
    sizes = docs.groupBy(label).agg(F.count("*").alias("docs")).orderBy(label).collect()
    classes = [r[label] for r in sizes]
    counts = settle(pairs.groupBy("term", label).agg(F.sum("tf").alias("n")))
    totals = {r[label]: r["n"] for r in counts.groupBy(label).agg(F.sum("n").alias("n")).collect()}
    width = counts.select(F.count_distinct("term")).first()[0]
    n = sum(r["docs"] for r in sizes)
    priors = [log(r["docs"]) - log(n) if fit_prior else -log(len(classes)) for r in sizes]
    denominators = [log(totals.get(c, 0) + alpha * width) for c in classes]
    index = docs.sparkSession.createDataFrame(list(enumerate(classes)), f"class int, {label} {dict(docs.dtypes)[label]}")
    gain = F.struct("class", (F.log(F.col("n") + float(alpha)) - log(alpha)).alias("gain"))
    terms = counts.join(F.broadcast(index), label).groupBy("term").agg(F.collect_list(gain).alias("gains"), F.sum("n").alias("cf"))
    return NaiveBayesTable(classes, priors, denominators, log(alpha), terms)


def naive_bayes_score(model: NaiveBayesTable, pairs: DataFrame, docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, prediction, probability, confidence)``, one row per distinct id of ``docs``; unknown terms are ignored.
    ``pairs`` is read more than once, so it should be a written table.

    Every document starts with a 0 per class, so its sums come as an array in class order, and all else is linear in the classes.
    """
    most = FREQUENT_VALUES // (4 * max(8, len(model.classes)))
    hits = frequent_join(pairs.select(id, "term", "tf"), write_side(model.terms), "term", "cf", most)
    # class -1 counts the known words of a document
    gains = hits.select(id, "tf", F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("class"), F.lit(1.0).alias("gain"))), "gains")).alias("g"))
    zeros = docs.select(id, F.explode(F.sequence(F.lit(-1), F.lit(len(model.classes) - 1))).alias("class"), F.lit(0.0).alias("s"))
    sums = gains.select(id, "g.class", (F.col("tf") * F.col("g.gain")).alias("s")).unionByName(zeros).groupBy(id, "class").agg(F.sum("s").alias("s"))
    rows = sums.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("class", "s"))).alias("s"))
    constants = F.array(*[F.lit(float(x)) for x in model.priors]), F.array(*[F.lit(model.log_alpha - d) for d in model.denominators])
    parts = F.arrays_zip(F.slice("s", 2, len(model.classes)).alias("s"), constants[0].alias("p"), constants[1].alias("d"))
    scores = let(F.struct(F.get("s", F.lit(0))["s"].alias("known"), parts.alias("parts")),
                 lambda x: F.transform(x["parts"], lambda c: c["p"] + x["known"] * c["d"] + c["s"]["s"]))
    powers = let(scores, lambda v: let(F.struct(v.alias("v"), F.array_max(v).alias("m")), lambda x: F.transform(x["v"], lambda y: F.exp(y - x["m"]))))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    shares = let(powers, lambda v: let(F.struct(v.alias("v"), total(v).alias("t")), lambda x: F.transform(x["v"], lambda y: y / x["t"])))
    return rows.select(id, F.explode(F.array(shares)).alias("probability")).select(
        id, predicted_class(F.col("probability"), model.classes).alias("prediction"), "probability", F.array_max("probability").alias("confidence"))


def predicted_class(probability: Column, classes: Sequence) -> Column:
    """Class at the first maximum."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.get(names, (F.array_position(probability, F.array_max(probability)) - 1).cast("int"))


# ---- MLlib estimators ----------------------------------------------------------------------

def naive_bayes(alpha: float = 1.0, **cols) -> NaiveBayes:
    return NaiveBayes(modelType="multinomial", smoothing=alpha, **cols)


def lowest_value(df: DataFrame, features: str = "features") -> float:
    """Smallest feature value of the training rows, at most 0: what naive Bayes has to be shifted by."""
    low = df.select(F.min(F.array_min(vector_to_array(features)))).first()[0]
    return min(0.0, low if low is not None else 0.0)


def logistic_regression(rows: int, C: float = 1.0, max_iter: int = 1000, weight: str | None = "weight",
                        **cols) -> LogisticRegression:
    """Multinomial with L2 strength 1 / (C * rows), unscaled features."""
    lr = LogisticRegression(family="multinomial", regParam=1.0 / (C * rows), elasticNetParam=0.0, maxIter=max_iter,
                            standardization=False, **cols)
    return lr.setWeightCol(weight) if weight else lr


def random_forest(trees: int = 100, max_depth: int = 30, min_leaf: int = 1, seed: int = 42,
                  weight: str | None = "weight", **cols) -> Forest:
    """Trees on bootstrap samples that draw the root of the number of features for each node."""
    return Forest(trees, max_depth, min_leaf, seed=seed, weight=weight, per_node=None, **cols)


def bagging(trees: int = 100, max_samples: float = 1.0, max_depth: int = 30, seed: int = 42, **cols) -> Forest:
    """Bagged trees that see all features, each on a sample of the rows."""
    return Forest(trees, max_depth, rate=max_samples, seed=seed, **cols)


# ---- fitting, scoring ------------------------------------------------------------------------

def fit_report(model, sets: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """Accuracy, precision, recall and F1 of a fitted model per named set."""
    parts = [model.transform(df).select(F.lit(name).alias("set"), F.col(label).alias("label"), "prediction")
             for name, df in sets.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return weighted_metrics(union, ["set"])


def fit_with_report(fit: Callable[[DataFrame], object], sets: dict[str, DataFrame], names: Sequence[str] = (), label: str = "label") -> tuple[object, DataFrame]:
    """The model fitted on the first of the named sets, and ``(section, name, value)``: metrics per set, importances of the named features and the seconds of the fit."""
    start = time.time()
    model = fit(next(iter(sets.values())))
    seconds = time.time() - start
    metrics = fit_report(model, sets, label)
    rows = F.inline(F.array(*[F.struct(F.concat(F.lit(f"{m}:"), "set").alias("name"), F.col(m).alias("value")) for m in ("accuracy", "precision", "recall", "f1")]))
    report = metrics.select(F.lit("metrics").alias("section"), rows)
    own = [("time", "seconds", seconds), *[("importance", n, w) for n, w in feature_importances(model, names)]]
    return model, report.unionByName(_long_rows(report, own))


def _long_rows(report: DataFrame, rows: list[tuple[str, str, float]]) -> DataFrame:
    return report.sparkSession.createDataFrame(rows, "section string, name string, value double")


def predict(model, df: DataFrame, width: int | None = None, features: str = "features", classes: int | None = None,
            keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Predictions with class probabilities and confidence, the highest probability.

    A row whose vector has another width than ``width`` is an error, and so is a
    predicted index outside ``classes``.
    """
    if width is not None:
        df = VectorSizeHint(inputCol=features, size=width, handleInvalid="error").transform(df)
    out = model.transform(df)
    p = vector_to_array("probability")
    prediction = F.col("prediction")
    if classes is not None:
        prediction = F.when((prediction >= 0) & (prediction < classes), prediction).otherwise(
            F.raise_error(F.lit("prediction outside the known classes")).cast("double"))
    return out.select(*keep, prediction.alias("prediction"), p.alias("probability"), F.array_max(p).alias("confidence"))


def soft_vote(scores: DataFrame, weights: dict[str, float], classes: Sequence, id: str = "doc_id",
              model: str = "model", probability: str = "probability") -> DataFrame:
    """Weighted mean of the models' probabilities per document, and its first maximum; means that agree to nine digits are equal.

    ``scores(id, model, probability array)``: rows of a document meet by id, not by position.
    """
    weight = F.coalesce(*[F.when(F.col(model) == m, F.lit(float(w))) for m, w in weights.items()])
    summed = scores.where(F.col(model).isin(list(weights))).groupBy(id).agg(
        *[(F.sum(weight * F.get(F.col(probability), i)) / F.sum(weight)).alias(f"p{i}") for i in range(len(classes))])
    p = F.array(*[F.col(f"p{i}") for i in range(len(classes))])
    # equal means differ in their last bits
    steps = F.transform("probability", lambda x: F.round(x * 1e9))
    return summed.select(id, p.alias("probability")).withColumn("_steps", steps).select(
        id, "probability", predicted_class(F.col("_steps"), classes).alias("prediction"),
        F.array_max("probability").alias("confidence"))


def fit_until_no_gain(settings: Sequence, fit: Callable[[object], object], val: DataFrame, patience: int = 3,
                      max_rounds: int = 10, label: str = "label") -> tuple[object, list[tuple[int, float]]]:
    """Fit growing settings in turn; stop when validation F1 has not risen for ``patience`` rounds."""
    best, best_score, waited, history = None, -1.0, 0, []
    for i, setting in enumerate(list(settings)[:max_rounds]):
        model = fit(setting)
        score = MulticlassClassificationEvaluator(labelCol=label, metricName="f1").evaluate(model.transform(val))
        history.append((i, score))
        if score > best_score:
            best, best_score, waited = model, score, 0
        else:
            waited += 1
        if waited >= patience:
            break
    return best, history


def feature_importances(model, names: Sequence[str], k: int | None = None) -> list[tuple[str, float]]:
    """Named importances, highest first; for linear models the absolute coefficients of the first class."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()[0])
    elif hasattr(model, "models"):
        values = abs(model.models[0].coefficients.toArray())
    else:
        return []
    ranked = sorted(zip(names, (float(v) for v in values)), key=lambda p: (-p[1], p[0]))
    return ranked[:k] if k else ranked

