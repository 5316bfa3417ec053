"""Source, sink and log queries. What they write goes to the session's shared folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docloom.functions.scale import write_side
from docloom.functions.text import words
from docloom.operators import classify as c, evaluate as e, splits as s
from docloom.plans import ensembles
from docloom.plans.stages import feature_names
from docloom.sources import metrics, tables
from registry.common import docs, in_list, load, query, r, tidy, words_of, workspace
from registry.evaluation import FOLDED, P, fold_metrics, metrics_cte, preds
from registry.models import final_fit, folded_rows, stack_fits, text_model, vectors, weighted
from registry.splits import SPLIT, ranked

CSV = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])


@query("io01_csv_source", "SELECT doc_id, text, lang FROM documents")
def _(spark, sf):
    path = workspace(spark, "io01")
    tables.write_csv(docs(spark, sf).select("doc_id", "text", "lang"), path)
    return tables.read_csv(spark, path, CSV, ["text", "lang"])


@query("io01_parquet_source", "SELECT * FROM documents")
def _(spark, sf):
    return tables.read_parquet(spark, f"{sf}/documents.parquet", ["doc_id", "text", "lang"])


@query("io02_required_columns", "SELECT doc_id, quality, toxic FROM labels")
def _(spark, sf):
    try:
        tables.require_columns(load(spark, sf, "labels"), ["description"])
    except ValueError:
        return tidy(tables.require_columns(load(spark, sf, "labels"), ["quality"]))
    raise AssertionError("a missing column was accepted")


PREPARED = f"(SELECT s.doc_id, s.lang, s.split, n_chars, CAST(len({words_of('text')}) AS BIGINT) AS n_words FROM {SPLIT} s JOIN documents d USING (doc_id))"


def prepared(spark, sf, name):
    d = docs(spark, sf)
    parts = s.stratified_split(d.select("doc_id", "lang"), label="lang").select("doc_id", "split")
    rows = d.select("doc_id", "lang", "n_chars", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    path = workspace(spark, name)
    tables.save_prepared(rows.join(parts, "doc_id"), path)
    return path


@query("io03_prepared_round_trip", f"SELECT * FROM {PREPARED}")
def _(spark, sf):
    return tables.load_prepared(spark, prepared(spark, sf, "io03"))


@query("io03_prepared_test_split", f"SELECT * FROM {PREPARED} WHERE split = 'test'")
def _(spark, sf):
    return tables.load_prepared(spark, prepared(spark, sf, "io03t"), "test")


PARTS = "CASE WHEN vec_id % 5 = 0 THEN 'test' WHEN vec_id % 5 = 1 THEN 'val' ELSE 'train' END"


def prepared_set(spark, sf, name, split=None):
    """The embeddings as a prepared set with named positions, saved and loaded."""
    d = vectors(spark, sf).withColumn("split", F.expr(PARTS.replace("vec_id", "doc_id")))
    labels = s.label_index(d)
    path = workspace(spark, name)
    tables.save_prepared_set(s.encode_labels(d, labels), labels, path, [f"dim_{i}" for i in range(64)], ["embeddings"])
    return tables.load_prepared_set(spark, path, split)


@query("io03_prepared_features", f"""WITH l AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT label FROM embeddings))
SELECT doc_id, split, CAST(k AS DOUBLE) AS label_index, 'dim_' || i AS feature, {r('x')} AS value FROM (SELECT vec_id AS doc_id, label, {PARTS} AS split,
  generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS x FROM embeddings) JOIN l USING (label) WHERE split = 'val'""")
def _(spark, sf):
    rows, _labels, manifest = prepared_set(spark, sf, "io03f", "val")
    names = feature_names(rows, manifest["features"])
    cells = F.transform(vector_to_array("features"), lambda x, i: F.struct(F.get(F.lit(names), i).alias("feature"), x.alias("value")))
    return tidy(rows.select("doc_id", "split", "label_index", F.inline(cells)))


@query("io03_prepared_labels", "SELECT CAST(label AS DOUBLE) AS label, CAST(row_number() OVER (ORDER BY label) - 1 AS DOUBLE) AS label_index FROM (SELECT DISTINCT label FROM embeddings)")
def _(spark, sf):
    return prepared_set(spark, sf, "io03l")[1]


@query("io04_prepared_report", f"SELECT split, count(*) AS rows, count(DISTINCT lang) AS classes FROM {PREPARED} GROUP BY split")
def _(spark, sf):
    return tidy(tables.prepared_report(tables.load_prepared(spark, prepared(spark, sf, "io04")), "lang"))


@query("io04_vector_report", """
SELECT CASE WHEN vec_id % 2 = 0 THEN 'even' ELSE 'odd' END AS split, count(*) AS rows, count(DISTINCT label) AS classes, CAST(max(len(embedding)) AS BIGINT) AS width
FROM embeddings GROUP BY ALL""")
def _(spark, sf):
    path = workspace(spark, "io04v")
    halves = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    tables.save_prepared(vectors(spark, sf).withColumn("split", halves), path)
    return tidy(tables.prepared_report(tables.load_prepared(spark, path), "label", "features"))


@query("io05_cached_batches", f"SELECT doc_id, lang, CAST(floor((rank - 1) / 32) AS BIGINT) AS batch_id FROM {ranked()}")
def _(spark, sf):
    folder = workspace(spark, f"io05/{sf.rstrip("/").rsplit("/", 1)[-1]}")
    build = lambda: s.batches(docs(spark, sf).select("doc_id", "lang"), 32)
    tables.cached_batches(spark, folder, "all", 32, build)
    return tidy(tables.cached_batches(spark, folder, "all", 32, build))


LOGGED = "SELECT fold AS step, unnest([{names}]) AS name, unnest([{values}]) AS value FROM wm"


def logged(experiment: str, names) -> str:
    picked = LOGGED.format(names=in_list(names), values=", ".join(r(n) for n in names))
    return f"SELECT '{experiment}' AS experiment_id, 'val' AS metric_type, CAST(step AS BIGINT) AS step, name, value FROM ({picked})"


@query("io06_metrics_log", f"WITH {FOLDED}, {metrics_cte('fold')} {logged('rules', e.METRICS)}")
def _(spark, sf):
    folder = workspace(spark, "io06")
    rows = metrics.long_to_metrics(fold_metrics(spark, sf), "rules", "val", "fold", e.METRICS)
    rows.write.mode("overwrite").partitionBy("experiment_id").json(folder)
    return tidy(metrics.load_metrics(spark, folder, "rules").drop("ts"))


@query("e27_logged_metrics", f"""WITH {FOLDED}, {metrics_cte('fold')},
whole AS (WITH {P} SELECT count_if(label = prediction) / CAST(count(*) AS DOUBLE) AS accuracy FROM pr)
{logged('run', ['f1'])} UNION ALL SELECT 'run', 'overall', 0, 'accuracy', {r('accuracy')} FROM whole""")
def _(spark, sf):
    folder = workspace(spark, "e27")
    first = metrics.long_to_metrics(fold_metrics(spark, sf), "run", "val", "fold", ["f1"])
    first.write.mode("overwrite").partitionBy("experiment_id").json(folder)
    accuracy = e.accuracy(preds(spark, sf)).first()["accuracy"]
    metrics.log_metrics(metrics.metric_rows(spark, "run", "overall", 0, {"accuracy": accuracy}), folder)
    return tidy(metrics.load_metrics(spark, folder).drop("ts"))


def reloaded(spark, name, model, stage):
    path = workspace(spark, name)
    tables.save_bundle(PipelineModel([model]), path)
    return tables.load_bundle(spark, path, [stage])


def same_after_reload(spark, name, model, d, stage):
    """Every row with whether the saved model predicts what the fitted one does, in class and probability."""
    again = reloaded(spark, name, model, stage)
    p = F.transform(vector_to_array("probability"), lambda x: F.round(x, 9))
    mine = model.transform(d).select("doc_id", "label", F.col("prediction").alias("a"), p.alias("p"))
    its = again.transform(d).select("doc_id", F.col("prediction").alias("b"), p.alias("q"))
    return tidy(mine.join(its, "doc_id").select("doc_id", "label", ((F.col("a") == F.col("b")) & (F.col("p") == F.col("q"))).alias("same")))


SAME = "SELECT vec_id AS doc_id, CAST(label AS DOUBLE) AS label, true AS same FROM embeddings"


@query("io07_saved_model")
def _(spark, sf):
    d = write_side(vectors(spark, sf))
    model = reloaded(spark, "io07", c.random_forest(weight=None).fit(d), "ForestModel")
    return tidy(model.transform(d).select("doc_id", "label", "prediction"))


@query("io07_saved_bagged_trees", SAME)
def _(spark, sf):
    d = weighted(spark, sf)
    return same_after_reload(spark, "io07b", ensembles.fit_bagged_trees(d, 64, 10, 0.7, 0.5, weight="weight", parallelism=8), d, "BaggedTrees")


@query("io07_saved_svm", SAME)
def _(spark, sf):
    d = weighted(spark, sf)
    return same_after_reload(spark, "io07s", ensembles.fit_calibrated_svm(d, parallelism=8), d, "CalibratedSvm")


@query("io07_saved_stack", SAME)
def _(spark, sf):
    folded = folded_rows(spark, sf, 3)
    n = folded.count()
    fits = stack_fits(5, 10)
    return same_after_reload(spark, "io07k", ensembles.fit_stack(folded, {k: fits[k] for k in ("bagging", "forest")}, final_fit(n)), folded, "Stack")


@query("io07_saved_text_model")
def _(spark, sf):
    model, _labels = text_model(spark, sf)
    path = workspace(spark, "io07t")
    tables.save_bundle(model, path)
    again = tables.load_bundle(spark, path, ["CountVectorizerModel", "VectorScalerModel", "NaiveBayesModel"])
    return tidy(again.transform(docs(spark, sf).select("doc_id", "text")).select("doc_id", "prediction"))


@query("io08_scoring_report", f"""WITH {P}, a AS (SELECT label, count(*) AS cases, CAST(count_if(label = prediction) AS BIGINT) AS "right" FROM pr GROUP BY label),
b AS (SELECT * FROM a UNION ALL SELECT '*', CAST(sum(cases) AS BIGINT), CAST(sum("right") AS BIGINT) FROM a)
SELECT label, cases, "right", {r('"right" / CAST(cases AS DOUBLE)')} AS accuracy FROM b""")
def _(spark, sf):
    folder = workspace(spark, "io08")
    p = preds(spark, sf)
    tables.write_scoring_report(p, e.label_accuracy(p), folder)
    return tidy(spark.read.schema("label string, cases long, right long, accuracy double").json(f"{folder}/accuracy"))
