"""Evaluation of ``predictions([keys…,] doc_id, label, prediction[, probability array])``.

Predictions are counted once into confusion cells (classes squared rows per key),
and every metric is arithmetic on that small table. ``keys`` evaluates many
models or folds in the same pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F, Window

from docloom.functions.scale import running_totals, write_side
from docloom.functions.text import ratio


METRICS = ("accuracy", "precision", "recall", "f1")


def confusion_cells(preds: DataFrame, keys: Sequence[str] = (), label: str = "label",
                    prediction: str = "prediction", count: str | None = None) -> DataFrame:
    """Rows per true and predicted class; ``count`` names a column of rows that are counted already."""
    return preds.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        (F.sum(count) if count else F.count("*")).alias("n"))


def class_pairs(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All (label, prediction) pairs of the classes seen, per key."""
    seen = cells.groupBy(*keys).agg(F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("classes"))
    return seen.select(*keys, "classes", F.explode("classes").alias("label")).select(
        *keys, "label", F.explode("classes").alias("prediction"))


def confusion_matrix(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """Count per true and predicted class, zero cells kept."""
    cells = confusion_cells(preds, keys, **columns)
    return class_pairs(cells, keys).join(cells, [*keys, "label", "prediction"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))


def accuracy(preds: DataFrame, keys: Sequence[str] = (), label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    return preds.groupBy(*keys).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def class_counts(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """TP, FP, FN, TN per class."""
    cells = confusion_cells(preds, keys, **columns)
    sides = cells.select(*keys, F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("truth"), F.lit(0).cast("long").alias("called"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("truth"), F.col("n").alias("called"),
                 F.lit(0).cast("long").alias("tp")))))
    per_class = sides.groupBy(*keys, "class").agg(F.sum("tp").alias("tp"), F.sum("truth").alias("truth"),
                                                  F.sum("called").alias("called"))
    total = F.sum("truth").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1)))
    return per_class.select(
        *keys, "class", "tp", (F.col("called") - F.col("tp")).alias("fp"), (F.col("truth") - F.col("tp")).alias("fn"),
        (total - F.col("truth") - F.col("called") + F.col("tp")).alias("tn"))


def class_metrics(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """Precision, recall, F1, specificity and support per class, 0 where undefined."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return class_counts(preds, keys, **columns).select(
        *keys, "class", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tn, tn + fp).alias("specificity"),
        (tp + fn).alias("support"))


def _average(metric: str, weight: Column) -> Column:
    return ratio(F.sum(F.col(metric) * weight), F.sum(weight))


def weighted_metrics(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1. (Weighted recall is the accuracy.)"""
    per_class = class_metrics(preds, keys, **columns)
    hits = F.sum(F.col("recall") * F.col("support")) / F.sum("support")
    return per_class.groupBy(*keys).agg(
        hits.alias("accuracy"), *[_average(m, F.col("support").cast("double")).alias(m) for m in METRICS[1:]])


def classification_report(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg``, from one pass over the predictions."""
    per_class = class_metrics(preds, keys, **columns)

    def average(name: str, weight: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), *[_average(m, weight).alias(m) for m in METRICS[1:]],
                        F.sum("support").alias("support"))

    row = F.struct(F.col("class").cast("string").alias("class"), *METRICS[1:], "support")
    averages = F.array(average("macro avg", F.lit(1.0)), average("weighted avg", F.col("support").cast("double")))
    return per_class.groupBy(*keys).agg(F.concat(F.collect_list(row), averages).alias("rows")).select(
        *keys, F.inline("rows"))


def confused_pairs(preds: DataFrame, keys: Sequence[str] = (), k: int = 3, **columns) -> DataFrame:
    """The k unordered class pairs taken for each other most often."""
    cells = confusion_cells(preds, keys, **columns).where("label <> prediction")
    pairs = cells.groupBy(*keys, F.least("label", "prediction").alias("class_a"),
                          F.greatest("label", "prediction").alias("class_b")).agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("class_a"), F.asc("class_b")]
    if not keys:
        return pairs.orderBy(*order).limit(k)
    ranked = pairs.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_r") <= k).drop("_r")


def error_rate(preds: DataFrame, keys: Sequence[str] = (), label: str = "label",
               prediction: str = "prediction") -> DataFrame:
    wrong = F.col(label) != F.col(prediction)
    return preds.groupBy(*keys).agg(F.count_if(wrong).alias("misclassified_count"),
                                    F.avg(wrong.cast("double")).alias("misclassification_rate"))


def error_cases(preds: DataFrame, id: str = "doc_id", label: str = "label", prediction: str = "prediction",
                probability: str | None = "probability", top_features: Sequence[tuple[str, float]] = ()) -> DataFrame:
    """Misclassified documents with confidence and the model's leading features."""
    wrong = preds.where(F.col(label) != F.col(prediction))
    out = [id, F.col(label).alias("true_label"), F.col(prediction).alias("predicted_label")]
    if probability:
        out.append(F.array_max(probability).alias("confidence"))
    if top_features:
        out.append(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(w)).alias("importance"))
                             for f, w in list(top_features)[:5]]).alias("important_features"))
    return wrong.select(*out)


def error_patterns(preds: DataFrame, keys: Sequence[str] = (), **columns) -> DataFrame:
    """Count per ordered pair ``a->b`` of different classes, zeros kept."""
    off = confusion_matrix(preds, keys, **columns).where("label <> prediction")
    return off.select(*keys, F.concat(F.col("label").cast("string"), F.lit("->"),
                                      F.col("prediction").cast("string")).alias("pattern"), "n")


# ---- ROC ----------------------------------------------------------------------------------

def class_scores(preds: DataFrame, classes: Sequence, id: str = "doc_id", label: str = "label",
                 probability: str = "probability") -> DataFrame:
    """Long form ``(id, class, score, hit)``; ``classes`` names the positions of the array."""
    named = F.array(*[F.struct(F.lit(c).alias("class"), F.get(F.col(probability), i).alias("score"))
                      for i, c in enumerate(classes)])
    long = preds.select(id, label, F.inline(named))
    return long.select(id, "class", "score", (F.col(label) == F.col("class")).cast("long").alias("hit"))


def roc_points(scores: DataFrame, keys: Sequence[str] = ("class",), score: str = "score", hit: str = "hit", count: str | None = None) -> DataFrame:
    """ROC curve per key: threshold, true and false positive rate, one point per distinct score.

    Scores are counted per distinct value first; the cumulative sums run over
    slices, so a class with very many distinct scores is not one task.
    """
    n = F.col(count) if count else F.lit(1)
    tied = scores.groupBy(*keys, F.col(score).alias("threshold")).agg(
        F.sum(F.col(hit) * n).alias("pos"), F.sum((1 - F.col(hit)) * n).alias("neg"))
    run = running_totals(tied, list(keys), [F.desc("threshold")], {"tps": F.col("pos"), "fps": F.col("neg")})
    return run.select(*keys, "threshold", "pos", "neg", "tps", "fps",
                      ratio(F.col("tps"), F.col("tps_total")).alias("tpr"),
                      ratio(F.col("fps"), F.col("fps_total")).alias("fpr"),
                      F.col("tps_total").alias("positives"), F.col("fps_total").alias("negatives"))


def roc_auc(points: DataFrame, keys: Sequence[str] = ("class",)) -> DataFrame:
    """Area under each curve, trapezoids: each point adds its negatives times the mean of tps before and after."""
    area = F.col("neg").cast("double") * (2 * F.col("tps") - F.col("pos")).cast("double") / 2.0
    summed = points.groupBy(*keys).agg(F.sum(area).alias("a"), F.max("positives").alias("p"),
                                       F.max("negatives").alias("n"))
    return summed.select(*keys, ratio(F.col("a"), F.col("p").cast("double") * F.col("n").cast("double")).alias("auc"))


# ---- folds and models ---------------------------------------------------------------------

def long_metrics(wide: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return wide.select(*keys, F.inline(rows))


def cross_validation_summary(fold_metrics: DataFrame, keys: Sequence[str] = (), metrics: Sequence[str] = METRICS,
                             fold: str = "fold") -> DataFrame:
    """Per metric over folds: mean, population std and mean ± 1.96 std / sqrt(k)."""
    long = long_metrics(fold_metrics, [*keys, fold], metrics)
    m = long.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                          F.count("*").alias("folds"))
    half = 1.96 * F.col("std") / F.sqrt("folds")
    return m.select(*keys, "metric", "mean", "std", (F.col("mean") - half).alias("ci_low"),
                    (F.col("mean") + half).alias("ci_high"))


@lru_cache(maxsize=None)
def t_quantile(freedom: int, level: float = 0.95) -> float:
    """Two-sided quantile of Student's t.

    With t = sqrt(v) tan(x) the density is proportional to cos(x) ** (v - 1): its integral is tabulated by Simpson's rule up
    to where it is negligible and the point that holds ``level`` of it is interpolated.
    """
    end = min(math.pi / 2, 12 / math.sqrt(freedom)) if freedom > 1 else math.pi / 2
    steps = 20_000
    h = end / steps
    f = [math.cos(min(i * h / 2, math.pi / 2)) ** (freedom - 1) for i in range(2 * steps + 1)]
    total, sums = 0.0, [0.0]
    for i in range(steps):
        total += h / 6 * (f[2 * i] + 4 * f[2 * i + 1] + f[2 * i + 2])
        sums.append(total)
    i = next(k for k, s in enumerate(sums) if s >= level * total)
    x = h * (i - 1 + (level * total - sums[i - 1]) / (sums[i] - sums[i - 1]))
    return math.sqrt(freedom) * math.tan(x)


def cross_validation_t_interval(fold_metrics: DataFrame, keys: Sequence[str] = (), metric: str = "f1") -> DataFrame:
    """Mean, population std and the 95 % Student t interval of one metric over folds."""
    m = fold_metrics.groupBy(*keys).agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"),
                                        F.stddev_samp(metric).alias("sample_std"), F.count("*").alias("folds"))
    counts = [r[0] for r in m.select("folds").distinct().collect()]
    table = F.create_map(*[F.lit(x) for k in counts if k > 1 for x in (k, t_quantile(k - 1))], F.lit(0), F.lit(None).cast("double"))
    t = F.try_element_at(table, F.col("folds").cast("int"))
    half = t * F.col("sample_std") / F.sqrt("folds")
    return m.select(*keys, "mean", "std", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def best_fold(fold_metrics: DataFrame, metric: str = "f1", fold: str = "fold") -> DataFrame:
    """The fold with the highest metric, the first on ties."""
    top = fold_metrics.agg(F.min(F.struct((-F.col(metric)).alias("v"), F.col(fold).alias("f"))).alias("b"))
    return top.select(F.col("b.f").alias(fold), (-F.col("b.v")).alias(metric))


def compare_models(preds: DataFrame, model: str = "model", **columns) -> DataFrame:
    """Accuracy, precision, recall and F1 of all models in one pass."""
    return weighted_metrics(preds, [model], **columns)


def rank_models(comparison: DataFrame, metrics: Sequence[str] = ("accuracy", "f1"), model: str = "model") -> DataFrame:
    long = long_metrics(comparison, [model], metrics)
    order = Window.partitionBy("metric").orderBy(F.desc("value"), F.asc(model))
    return long.withColumn("rank", F.row_number().over(order))


def tuning_gain(comparison: DataFrame, model: str = "model", stage: str = "stage") -> DataFrame:
    """Initial against tuned metrics per model, with the difference."""
    long = long_metrics(comparison, [model, stage])
    both = long.groupBy(model, "metric").agg(F.max(F.when(F.col(stage) == "initial", F.col("value"))).alias("initial"),
                                             F.max(F.when(F.col(stage) == "tuned", F.col("value"))).alias("tuned"))
    return both.withColumn("improvement", F.col("tuned") - F.col("initial"))


def best_model(comparison: DataFrame, metric: str = "f1", model: str = "model", stage: str = "stage") -> DataFrame:
    """The model and stage with the highest metric; tuned wins a tie within a model, then the first name."""
    key = F.struct((-F.col(metric)).alias("v"), (F.col(stage) != "tuned").alias("t"), F.col(model).alias("m"))
    top = comparison.agg(F.min(F.struct(key.alias("k"), F.col(stage).alias("s"))).alias("b"))
    return top.select(F.col("b.k.m").alias("model_type"), (F.col("b.s") == "tuned").alias("is_tuned"),
                      (-F.col("b.k.v")).alias(metric), F.lit(f"{metric} (weighted)").alias("metric_used"))


def feature_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, as one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                                  F.col(f"c{i}").alias("correlation"))
                                         for i, (a, b) in enumerate(pairs)])))


def vector_correlations(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """Pearson correlation of every pair of vector positions, for wide feature vectors.

    MLlib sums the products over the rows in tasks; the cells of its matrix are made rows by Spark and never come to Python.
    """
    matrix = Correlation.corr(df, features)
    cells = matrix.select(F.posexplode(F.unwrap_udt(matrix.columns[0]).getField("values")).alias("cell", "correlation"))
    n, of = F.lit(len(names)), F.lit(list(names))
    i, j = (F.col("cell") % n).cast("int"), F.floor(F.col("cell") / n).cast("int")
    return cells.where(i <= j).select(F.get(of, i).alias("feature_a"), F.get(of, j).alias("feature_b"), "correlation")


def label_accuracy(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Scored cases, right ones and accuracy per label, plus the row ``*`` for all."""
    per_label = preds.groupBy(F.col(label).cast("string").alias("label")).agg(
        F.count("*").alias("cases"), F.count_if(F.col(label) == F.col(prediction)).alias("right"))
    overall = per_label.agg(F.lit("*").alias("label"), F.sum("cases").alias("cases"), F.sum("right").alias("right"))
    return per_label.unionByName(overall).withColumn("accuracy", ratio(F.col("right"), F.col("cases")))


def evaluation_tally(preds: DataFrame, classes: Sequence, fold: str | None = None, id: str = "doc_id", label: str = "label",
                     prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """What an evaluation needs of its predictions, from one scan of them: ``kind, fold, label, prediction, id, class, score, hit, n``.

    ``cell`` rows count (fold, label, prediction), ``score`` rows a class's distinct scores, ``case`` rows are the wrong predictions.
    """
    def entry(kind: str, **given: Column) -> Column:
        types = {"fold": "int", "label": "string", "prediction": "string", "id": "string", "class": "string", "score": "double", "hit": "long"}
        return F.struct(F.lit(kind).alias("kind"), *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    true, called = F.col(label), F.col(prediction)
    cell = entry("cell", label=true, prediction=called, **({"fold": F.col(fold)} if fold else {}))
    scores = [entry("score", **{"class": F.lit(str(c)), "score": F.get(F.col(probability), F.lit(i)), "hit": (true == c).cast("long")}) for i, c in enumerate(classes)]
    case = F.array(entry("case", label=true, prediction=called, id=F.col(id), score=F.array_max(probability)))
    rows = F.concat(F.array(cell, *scores), F.filter(case, lambda x: ~x["label"].eqNullSafe(x["prediction"])))
    flat = preds.select(F.inline(rows))
    return flat.groupBy(*flat.columns).agg(F.count("*").alias("n"))


def evaluation_bundle(preds: DataFrame, classes: Sequence, fold: str | None = None, **columns) -> DataFrame:
    """The whole evaluation of one model as ``(section, name, value)``, from one scan of ``preds``.

    Sections: ``overall`` and ``class`` metrics, ``counts``, ``errors`` per pair of classes, ``auc`` per class and micro, ``case`` (confidence of every
    wrong prediction), and with a ``fold`` column ``fold`` metrics and their ``cross_validation`` summary.
    """
    tally = write_side(evaluation_tally(preds, classes, fold, **columns))
    cells, scores = tally.where("kind = 'cell'"), tally.where("kind = 'score'")

    def section(name: str, df: DataFrame, key: Column, value: str | Column = "value") -> DataFrame:
        return df.select(F.lit(name).alias("section"), key.cast("string").alias("name"), F.col(value).cast("double").alias("value") if isinstance(value, str) else value.alias("value"))

    wrong = F.when(~F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0)
    totals = cells.agg(F.sum("n").alias("cases"), F.sum(wrong).alias("misclassified_count"), ratio(F.sum(wrong), F.sum("n")).alias("misclassification_rate"))
    totals = totals.withColumns({c: F.col(c).cast("double") for c in totals.columns})
    parts = [
        section("overall", long_metrics(weighted_metrics(cells, count="n"), []), F.col("metric")),
        section("class", long_metrics(class_metrics(cells, count="n"), ["class"], ("precision", "recall", "f1", "specificity")), F.concat_ws(":", "class", "metric")),
        section("counts", long_metrics(totals, [], totals.columns), F.col("metric")),
        section("errors", error_patterns(cells, count="n"), F.col("pattern"), "n"),
        section("auc", roc_auc(roc_points(scores, count="n")), F.col("class"), "auc"),
        section("auc", roc_auc(roc_points(scores, keys=(), count="n"), keys=()), F.lit("micro"), "auc"),
        section("case", tally.where("kind = 'case'"), F.concat("id", F.lit(":"), F.coalesce("label", F.lit("NULL")), F.lit("->"), F.coalesce("prediction", F.lit("NULL"))), "score"),
    ]
    if fold:
        per_fold = write_side(weighted_metrics(cells, ["fold"], count="n"))
        summary = cross_validation_summary(per_fold).withColumnRenamed("metric", "of")
        parts += [section("fold", long_metrics(per_fold, ["fold"]), F.concat_ws(":", F.col("fold").cast("string"), "metric")),
                  section("cross_validation", long_metrics(summary, ["of"], ("mean", "std", "ci_low", "ci_high")), F.concat_ws(":", "of", "metric"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
