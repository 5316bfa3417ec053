"""Append-only experiment metrics: one row per metric value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "experiment_id string, metric_type string, step long, ts timestamp, name string, value double"


def metric_rows(spark: SparkSession, experiment: str, metric_type: str, step: int, values: dict[str, float]) -> DataFrame:
    rows = [(experiment, metric_type, step, n, float(v)) for n, v in values.items()]
    df = spark.createDataFrame(rows, "experiment_id string, metric_type string, step long, name string, value double")
    return df.withColumn("ts", F.current_timestamp())


def log_metrics(df: DataFrame, folder: str) -> None:
    df.write.mode("append").partitionBy("experiment_id").json(folder)


def load_metrics(spark: SparkSession, folder: str, experiment: str | None = None) -> DataFrame:
    df = spark.read.schema(SCHEMA).json(folder)
    return df.where(F.col("experiment_id") == experiment) if experiment else df


def long_to_metrics(df: DataFrame, experiment: str, metric_type: str, step: str, names: Sequence[str]) -> DataFrame:
    """Wide metric columns of a result table as metric rows."""
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names])
    return df.select(F.lit(experiment).alias("experiment_id"), F.lit(metric_type).alias("metric_type"),
                     F.col(step).cast("long").alias("step"), F.current_timestamp().alias("ts"), F.inline(rows))
