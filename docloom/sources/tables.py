"""Document tables in, prepared tables and reports out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

TRIALS = StructType([StructField("description", StringType()), StructField("label", StringType())])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` for missing columns, before anything runs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def read_csv(spark: SparkSession, path: str, schema: StructType = TRIALS,
             required: Sequence[str] = ("description", "label")) -> DataFrame:
    """CSV with header; quoted fields may hold line breaks. The header must name the schema's columns."""
    header = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    require_columns(header, required)
    return header.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in header.columns])


def read_parquet(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    return require_columns(spark.read.parquet(path), required)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', quote='"', quoteAll=True)


def save_prepared(df: DataFrame, path: str, split: str = "split") -> None:
    """Features and labels, one folder per split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def load_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All splits, or one: then only its folder is read."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def save_prepared_set(rows: DataFrame, labels: DataFrame, path: str, names: Sequence[str], feature_types: Sequence[str] = (),
                      features: str = "features", label: str = "label", split: str = "split") -> None:
    """Prepared rows with what is needed to read them: the label table, the name of every vector position, and a manifest, which is written last.

    ``rows`` has a vector column and one row per document; data go to ``data``, one folder per split.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy(split).parquet(f"{path}/data")
    labels.write.mode("overwrite").parquet(f"{path}/labels")
    spark.createDataFrame(list(enumerate(names)), "position int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/names")
    manifest = [(features, label, split, len(names), list(feature_types))]
    spark.createDataFrame(manifest, "features string, label string, split string, width int, feature_types array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def load_prepared_set(spark: SparkSession, path: str, split: str | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """The rows of all splits or one, with named vector positions, the label table, and the manifest. A set without a manifest is not complete."""
    if not exists(spark, f"{path}/manifest/_SUCCESS"):
        raise FileNotFoundError(f"no complete prepared set at {path}")
    manifest = spark.read.json(f"{path}/manifest").first().asDict()
    names = [r["name"] for r in spark.read.parquet(f"{path}/names").orderBy("position").collect()]
    if len(names) != manifest["width"]:
        raise ValueError(f"{len(names)} names for {manifest['width']} positions at {path}")
    rows = spark.read.parquet(f"{path}/data")
    rows = rows.where(F.col(manifest["split"]) == split) if split else rows
    column = manifest["features"]
    attributes = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": len(names)}}
    return rows.withColumn(column, F.col(column).alias(column, metadata=attributes)), spark.read.parquet(f"{path}/labels"), manifest


def prepared_report(df: DataFrame, label: str = "label", features: str | None = None) -> DataFrame:
    """Rows, classes and vector width per split."""
    aggs = [F.count("*").alias("rows"), F.count_distinct(label).alias("classes")]
    if features:
        vector = isinstance(df.schema[features].dataType, VectorUDT)
        width = F.size(vector_to_array(features)) if vector else F.size(features)
        aggs.append(F.max(width).cast("long").alias("width"))
    return df.groupBy("split").agg(*aggs)


def cached_batches(spark: SparkSession, folder: str, split: str, size: int, build) -> DataFrame:
    """Batch table of a split, built on first use and read back afterwards.

    A table counts as present once its ``_SUCCESS`` marker is, so a job that died
    half way is built again.
    """
    path = f"{folder.rstrip('/')}/{split}_batch_{size}"
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_bundle(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_bundle(spark: SparkSession, path: str, stages: Sequence[str] = ()) -> PipelineModel:
    """Load a saved model and check that the named stage classes are in it."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    model = PipelineModel.load(path)
    present = {type(s).__name__ for s in model.stages}
    missing = [s for s in stages if s not in present]
    if missing:
        raise ValueError(f"model at {path} lacks: {', '.join(missing)}")
    return model


def write_scoring_report(preds: DataFrame, report: DataFrame, folder: str) -> None:
    """Per-case predictions and the accuracy table."""
    preds.write.mode("overwrite").parquet(f"{folder}/cases")
    report.coalesce(1).write.mode("overwrite").json(f"{folder}/accuracy")
