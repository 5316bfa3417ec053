"""Training, scoring and ensemble queries."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from docloom.functions.scale import write_side
from docloom.functions.text import word_tokens
from docloom.operators import classify as c, evaluate as e, features as f, splits as s
from docloom.plans import ensembles, experiment, prepare, tuning
from docloom.plans.scaling import MINMAX, VectorScaler
from docloom.plans.stages import ShiftFeatures
from docloom.sources import metrics
from docloom.streaming import scoring
from registry.common import WORD_TOKENS, dealt, docs, in_list, labelled, lit, load, query, r, tidy, workspace
from registry.evaluation import CLASSES, all_preds, rule_sql


DIMENSIONS = [f"dim_{i}" for i in range(64)]


def vectors(spark, sf):
    """The embeddings table as a training table ``(doc_id, label, features)``."""
    emb = dealt(load(spark, sf, "embeddings"))
    vec = array_to_vector(F.col("embedding").cast("array<double>"))
    return emb.select(F.col("vec_id").alias("doc_id"), F.col("label").cast("double"), vec.alias("features"))


def weighted(spark, sf):
    """Training rows with class weights, written once for all passes of a fit."""
    return write_side(c.with_balanced_weights(vectors(spark, sf)))


def folded_rows(spark, sf, k):
    d = weighted(spark, sf)
    return write_side(d.join(s.stratified_folds(d, k=k).select("doc_id", "fold"), "doc_id"))


def predictions(model, df):
    return tidy(model.transform(df).select("doc_id", "label", "prediction"))


def verdicts(model, df):
    """What holds for every fitted classifier: all rows scored, probabilities that sum to 1, known classes, more right than the largest class has rows."""
    scored = write_side(model.transform(df).select("doc_id", "label", "prediction", vector_to_array("probability").alias("p")))
    sizes = scored.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right"))
    beats = sizes.agg(F.sum("right") > F.max("n")).scalar()
    classes = scored.agg(F.max("label")).scalar()
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return tidy(scored.select("doc_id", "label", total.alias("probability_sum"), F.col("prediction").between(F.lit(0.0), classes).alias("known_class"),
                              beats.alias("beats_majority")))


VERDICTS = "SELECT vec_id AS doc_id, CAST(label AS DOUBLE) AS label, CAST(1 AS DOUBLE) AS probability_sum, true AS known_class, true AS beats_majority FROM embeddings"


NB = f"""
t AS (SELECT doc_id, lang, term, count(*) AS tf FROM (SELECT doc_id, lang, unnest({WORD_TOKENS}) AS term FROM documents) GROUP BY ALL),
cnt AS (SELECT term, lang, sum(tf) AS n FROM t GROUP BY term, lang),
cl AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
tot AS (SELECT lang, sum(n) AS n FROM cnt GROUP BY lang),
vs AS (SELECT count(DISTINCT term) AS v FROM cnt),
pri AS (SELECT lang, ln(docs) - ln((SELECT count(*) FROM documents)) AS prior, ln(tot.n + v) AS den FROM cl JOIN tot USING (lang), vs),
ll AS (SELECT te.term, cl.lang, ln(coalesce(cnt.n, 0) + 1.0) AS lc FROM (SELECT DISTINCT term FROM cnt) te CROSS JOIN cl LEFT JOIN cnt USING (term, lang)),
sm AS (SELECT doc_id, ll.lang, sum(tf * lc) AS s, sum(tf) AS k FROM t JOIN ll USING (term) GROUP BY doc_id, ll.lang),
sc AS (SELECT d.doc_id, pri.lang, prior + coalesce(s, 0) - coalesce(k, 0) * den AS score FROM documents d CROSS JOIN pri
  LEFT JOIN sm ON sm.doc_id = d.doc_id AND sm.lang = pri.lang),
mx AS (SELECT doc_id, max(score) AS m FROM sc GROUP BY doc_id)
SELECT doc_id, arg_max(lang, score) AS prediction, {r('1 / sum(exp(score - m))', 4)} AS confidence FROM sc JOIN mx USING (doc_id) GROUP BY doc_id"""


@query("m01_naive_bayes", f"WITH {NB}")
def _(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", "text")
    pairs = write_side(f.term_counts(d, word_tokens(F.col("text")), carry=["lang"]))
    model = c.naive_bayes_fit(pairs, d, label="lang")
    return tidy(c.naive_bayes_score(model, pairs, d).select("doc_id", "prediction", "confidence"), 4)


@query("m01_naive_bayes_vectors")
def _(spark, sf):
    d = vectors(spark, sf)
    shift = ShiftFeatures(inputCol="features", low=float(c.lowest_value(d)))
    model = PipelineModel([shift, c.naive_bayes().fit(shift.transform(d))])
    return predictions(model, d)


@query("m02_logistic_regression")
def _(spark, sf):
    d = weighted(spark, sf)
    return predictions(c.logistic_regression(d.count(), max_iter=1000).fit(d), d)


@query("m03_calibrated_svm", VERDICTS)
def _(spark, sf):
    d = weighted(spark, sf)
    return verdicts(ensembles.fit_calibrated_svm(d), d)


@query("m04_random_forest", VERDICTS)
def _(spark, sf):
    d = weighted(spark, sf)
    return verdicts(c.random_forest().fit(d), d)


@query("m05_bagging", VERDICTS)
def _(spark, sf):
    d = write_side(vectors(spark, sf))
    return verdicts(c.bagging().fit(d), d)


@query("m05_feature_bagging", VERDICTS)
def _(spark, sf):
    d = weighted(spark, sf)
    return verdicts(ensembles.fit_bagged_trees(d, 64, max_samples=0.7, max_features=0.5, weight="weight", parallelism=8), d)


@query("m06_balanced_weights", f"""
WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, {r('(SELECT sum(n) FROM n) / CAST((SELECT count(*) FROM n) * n AS DOUBLE)')} AS weight FROM n""")
def _(spark, sf):
    return tidy(c.balanced_weights(docs(spark, sf), "lang"))


@query("m06_weighted_rows", f"""
WITH b AS (SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT quality, count(*) AS n FROM b GROUP BY quality)
SELECT doc_id, b.quality, {r('(SELECT sum(n) FROM n) / CAST((SELECT count(*) FROM n) * n AS DOUBLE)')} AS weight FROM b JOIN n ON b.quality IS NOT DISTINCT FROM n.quality""")
def _(spark, sf):
    return tidy(c.with_balanced_weights(labelled(spark, sf).select("doc_id", "quality"), "quality"))


@query("m09_fit_report")
def _(spark, sf):
    d = weighted(spark, sf)
    rows = write_side(d.join(s.stratified_split(d).select("doc_id", "split"), "doc_id"))
    sets = {name: rows.where(F.col("split") == name) for name in ("train", "val")}
    n = sets["train"].count()
    _model, report = c.fit_with_report(lambda t: c.logistic_regression(n, max_iter=1000).fit(t), sets, DIMENSIONS)
    return tidy(report.where("section <> 'time'"), 4)


@query("m10_checked_predictions")
def _(spark, sf):
    d = weighted(spark, sf)
    model = c.logistic_regression(d.count(), max_iter=1000).fit(d)
    return tidy(c.predict(model, d, width=64, classes=10).select("doc_id", "prediction"))


@query("m11_confidence")
def _(spark, sf):
    d = weighted(spark, sf)
    model = c.logistic_regression(d.count(), max_iter=1000).fit(d)
    return tidy(c.predict(model, d).select("doc_id", F.size("probability").alias("classes"), "confidence"), 4)


def text_model(spark, sf):
    """Cleaning, the default features, their scaling and naive Bayes as one model, and the label of each index."""
    d = docs(spark, sf).select("doc_id", "text", F.col("lang").alias("label"))
    index = s.label_index(d)
    cleaned = prepare.clean_once(d)
    stages = prepare.fit_stages(cleaned, statistics=True)
    coded = write_side(s.encode_labels(PipelineModel(stages).transform(cleaned), index).select("doc_id", "label_index", "features"))
    scaler = VectorScaler(kind=MINMAX, clip=True).fit(coded)
    nb = c.naive_bayes(featuresCol="scaled", labelCol="label_index").fit(scaler.transform(coded))
    labels = [row["label"] for row in index.orderBy("label_index").collect()]
    return PipelineModel([prepare.cleaner(), *stages, scaler, nb]), labels


@query("m12_table_scoring")
def _(spark, sf):
    model, labels = text_model(spark, sf)
    return tidy(scoring.score_all(model, docs(spark, sf).select("doc_id", "text"), labels), 4)


@query("m13_stream_scoring")
def _(spark, sf):
    model, labels = text_model(spark, sf)
    folder = workspace(spark, f"m13/{sf.rstrip("/").rsplit("/", 1)[-1]}")
    d = docs(spark, sf).select("doc_id", "text")
    d.write.mode("overwrite").parquet(f"{folder}/in")
    stream = spark.readStream.schema("doc_id long, text string").parquet(f"{folder}/in")
    run = spark.range(1).select(F.expr("uuid()")).first()[0]
    scoring.score_stream(model, stream, labels, f"{folder}/{run}/out", f"{folder}/{run}/state").awaitTermination()
    return tidy(spark.read.parquet(f"{folder}/{run}/out"), 4)


@query("m15_soft_vote", f"""
WITH pr AS ({rule_sql('five', 'tuned')} UNION ALL {rule_sql('one', 'tuned')}),
u AS (SELECT doc_id, CASE model WHEN 'five' THEN CAST(1.5 AS DOUBLE) ELSE 1.0 END AS w, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM pr),
m AS (SELECT doc_id, i, sum(w * x) / sum(w) AS x FROM u GROUP BY doc_id, i)
SELECT doc_id, ([{in_list(CLASSES)}])[arg_max(i, round(x, 9) - i * 1e-12)] AS prediction, {r('max(x)')} AS confidence FROM m GROUP BY doc_id""")
def _(spark, sf):
    p = all_preds(spark, sf).where("stage = 'tuned'")
    return tidy(c.soft_vote(p, {"five": 1.5, "one": 1.0}, CLASSES).select("doc_id", "prediction", "confidence"))


def stack_fits(bagged=50, trees=100, iterations=100):
    """The three base models of the stack."""
    return {"bagging": lambda t: ensembles.fit_bagged_trees(t, 64, bagged, 0.5, 0.3, parallelism=8),
            "forest": lambda t: c.random_forest(trees, min_leaf=2).fit(t),
            "svm": lambda t: ensembles.fit_calibrated_svm(t, C=0.5, max_iter=iterations, folds=2, parallelism=8)}


def final_fit(n):
    return lambda t, col: c.logistic_regression(n, C=0.3, max_iter=1000, featuresCol=col).fit(t)


@query("m16_stacking", VERDICTS)
def _(spark, sf):
    folded = folded_rows(spark, sf, 3)
    n = folded.count()
    return verdicts(ensembles.fit_stack(folded, stack_fits(), final_fit(n)), folded)


@query("m17_early_stopped_fit")
def _(spark, sf):
    d = weighted(spark, sf)
    rows = write_side(d.join(s.stratified_split(d).select("doc_id", "split"), "doc_id"))
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    n = train.count()
    best, _history = c.fit_until_no_gain([1, 5, 10, 20, 40], lambda i: c.logistic_regression(n, max_iter=i).fit(train), val, patience=2)
    return predictions(best, d)


#: Forests, SVMs and bagged trees are searched in the same way; their grids take minutes to hours (README).
SEARCHED = ("naive_bayes", "logistic_regression")
POINTS = " UNION ALL ".join(f"SELECT '{m}' AS model, {lit(json.dumps(p, sort_keys=True))} AS setting" for m in SEARCHED for p in tuning.points(tuning.GRIDS[m]))


@query("m19_grid_search", f"SELECT model, setting, CAST(f.fold AS BIGINT) AS fold, true AS scored FROM ({POINTS}), (SELECT unnest(range(5)) AS fold) AS f")
def _(spark, sf):
    folded = folded_rows(spark, sf, 5)
    folder = workspace(spark, f"m19/{spark.range(1).select(F.expr('uuid()')).first()[0]}")
    scores = tuning.search(folded, tuning.candidates(SEARCHED, 64), folder, parallelism=4)
    within = [F.col(m).between(0.0, 1.0) for m in e.METRICS]
    return tidy(scores.select("model", "setting", "fold", (within[0] & within[1] & within[2] & within[3]).alias("scored")))


@query("e24_feature_importances")
def _(spark, sf):
    d = weighted(spark, sf)
    model = c.random_forest().fit(d)
    top = c.feature_importances(model, DIMENSIONS, 10)
    return tidy(spark.createDataFrame(top, "feature string, importance double"), 4)


@query("e26_experiment")
def _(spark, sf):
    d = weighted(spark, sf)
    n = d.count()
    folder = workspace(spark, f"e26/{spark.range(1).select(F.expr('uuid()')).first()[0]}")
    run = experiment.run_experiment(d, lambda t: c.logistic_regression(n, max_iter=1000).fit(t), "embeddings", folder, k=5,
                                    stratified=True, feature_names=DIMENSIONS)
    logged = metrics.load_metrics(spark, folder, "embeddings").where("metric_type IN ('train', 'val', 'final')")
    assert run.final_metrics.count() == 1
    return tidy(logged.select("metric_type", "step", "name", "value"), 4)


@query("e25_vector_correlations", """
WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT 'dim_' || a.i AS feature_a, 'dim_' || b.i AS feature_b, round(corr(a.v, b.v), 5) + 0.0 AS correlation
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def _(spark, sf):
    d = vectors(spark, sf)
    return tidy(e.vector_correlations(d, DIMENSIONS), 5)
