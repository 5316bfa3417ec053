"""Training runs: folds, metrics per fold, final fit, importances, saved state. A run that broke off goes on where it was."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators import classify, evaluate, splits
from docloom.sources import metrics
from docloom.sources.tables import exists

FOLD = "fold int, role string, accuracy double, precision double, recall double, f1 double"
IMPORTANCE = "fold int, feature string, importance double"
FINAL_FOLD = -1


@dataclass(frozen=True)
class Run:
    model: object
    fold_metrics: DataFrame
    summary: DataFrame
    importances: list[tuple[str, float]]
    final_metrics: DataFrame
    correlations: DataFrame | None = None


class RunState:
    """The finished parts of a run in a folder: a part counts once its table is complete, the run once its manifest is."""

    def __init__(self, spark: SparkSession, folder: str, experiment: str):
        self.spark, self.base = spark, f"{folder.rstrip('/')}-runs/{experiment}"

    def path(self, part: str) -> str:
        return f"{self.base}/{part}"

    def has(self, part: str) -> bool:
        return exists(self.spark, f"{self.path(part)}/_SUCCESS")

    def write(self, part: str, rows: list, schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(self.path(part))

    def read(self, part: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(part))

    def save_model(self, model: Model) -> None:
        model.write().overwrite().save(self.path("model"))
        self.write("model-saved", [(1,)], "done int")

    def load_model(self) -> Model:
        return DefaultParamsReader.loadParamsInstance(self.path("model"), self.spark)


def score_fold(folded: DataFrame, model: object, i: int, label: str = "label", fold: str = "fold") -> DataFrame:
    """Predictions of one fold's model on all rows: ``(fold, role, label, prediction)``."""
    return model.transform(folded).select(F.lit(i).alias("fold"), F.when(F.col(fold) == i, "val").otherwise("train").alias("role"),
                                          F.col(label).alias("label"), "prediction")


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """Train and validation metrics per fold, one grouped pass."""
    return evaluate.weighted_metrics(predictions, ["fold", "role"])


def run_experiment(df: DataFrame, fit: Callable[[DataFrame], object], experiment: str, folder: str | None = None,
                   k: int = 5, stratified: bool = False, label: str = "label", id: str = "doc_id",
                   feature_names: Sequence[str] = (), seed: int = 42) -> Run:
    """Folds, metrics and importances per fold, summary, final fit on all rows with its metrics, and feature correlations.

    ``df(id, label, features)`` is read once per fit, so it is kept in memory and on disk for the run. With ``folder``, each fold's results, the
    final model and its metrics go to ``<folder>-runs/<experiment>``, the manifest last, and the metrics to the log in ``folder``. The same
    call after a break fits only what is missing; after the end, nothing.
    """
    spark = df.sparkSession
    state = RunState(spark, folder, experiment) if folder else None
    make = splits.stratified_folds(df, id, label, k, seed) if stratified else splits.plain_folds(df, id, k, seed)
    folded = df.join(make.select(id, "fold"), id).persist()
    rows, ranked = [], []

    def weights(model: object, i: int) -> list:
        return [(i, n, w) for n, w in classify.feature_importances(model, feature_names)] if feature_names else []

    def finish(part: str, model: object | None, i: int) -> None:
        if model is not None:
            found = [tuple(r) for r in fold_metrics(score_fold(folded, model, i, label)).select("fold", "role", *evaluate.METRICS).collect()]
            own = weights(model, i)
            if state:
                state.write(f"{part}-importances", own, IMPORTANCE)
                state.write(part, found, FOLD)  # the mark that the part is done
        else:
            found = [tuple(r) for r in state.read(part, FOLD).collect()]
            own = [tuple(r) for r in state.read(f"{part}-importances", IMPORTANCE).collect()]
        rows.extend(found)
        ranked.extend(own)

    try:
        for i in range(k):
            finish(f"fold-{i}", None if state and state.has(f"fold-{i}") else fit(folded.where(F.col("fold") != i)), i)
        if state and state.has("model-saved"):
            model = state.load_model()
        else:
            model = fit(folded)
            if state:
                state.save_model(model)
        finish("final", None if state and state.has("final") else model, FINAL_FOLD)
        correlations = evaluate.vector_correlations(folded, feature_names) if feature_names else None
    finally:
        folded.unpersist()
    table = spark.createDataFrame(rows, FOLD)
    per_fold = table.where(F.col("fold") != FINAL_FOLD)
    final = table.where(F.col("fold") == FINAL_FOLD).drop("fold", "role")
    summary = evaluate.cross_validation_summary(per_fold.where("role = 'val'").drop("role"))
    importances = [(n, w) for i, n, w in ranked if i == FINAL_FOLD]
    if folder and not state.has("manifest"):
        log_run(per_fold, final, ranked, experiment, folder)
        state.write("manifest", [(experiment, k, id, label, seed)], "experiment string, folds int, id string, label string, seed int")
    return Run(model, per_fold, summary, importances, final, correlations)


def log_run(per_fold: DataFrame, final: DataFrame, ranked: list, experiment: str, folder: str) -> None:
    """The run's figures in the metrics log, written once; rows of this run are not logged a second time."""
    spark = per_fold.sparkSession
    if exists(spark, folder) and not metrics.load_metrics(spark, folder, experiment).where("metric_type = 'final'").isEmpty():
        return
    parts = [metrics.long_to_metrics(per_fold.where(F.col("role") == role), experiment, role, "fold", evaluate.METRICS) for role in ("train", "val")]
    parts.append(metrics.long_to_metrics(final.withColumn("fold", F.lit(0)), experiment, "final", "fold", evaluate.METRICS))
    columns = parts[0].columns
    for i in sorted({i for i, _, _ in ranked}):
        values = {n: w for j, n, w in ranked if j == i}
        kind, step = ("importance", 0) if i == FINAL_FOLD else ("fold_importance", i)
        parts.append(metrics.metric_rows(spark, experiment, kind, step, values).select(*columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    metrics.log_metrics(out.coalesce(1), folder)
