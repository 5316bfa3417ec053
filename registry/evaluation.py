"""Evaluation queries over rule-made predictions of the language.

A rule counts listed words per language in the whole text; the probability of a
language is (hits + 1) / (all hits + 4). So predictions are the same in both engines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from docloom.functions.text import matches
from docloom.operators import classify, evaluate as e
from docloom.operators.splits import expand_folds, stratified_folds
from registry.common import docs, in_list, labelled, query, r, tidy
from registry.splits import FOLDS

CLASSES = ["de", "en", "es", "fr"]
RULES = {
    ("five", "tuned"): [["der", "die", "und", "das", "er"], ["the", "of", "and", "to", "in"],
                        ["el", "los", "del", "es", "la"], ["le", "les", "et", "une", "la"]],
    ("five", "initial"): [["der", "er"], ["the", "in"], ["es", "la"], ["la", "les"]],
    ("one", "tuned"): [["der", "la"], ["the"], ["que"], ["que", "la"]],
    ("one", "initial"): [["der", "die", "un"], ["in"], ["la", "de"], ["de", "un"]],
}
DOC_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def rule_predictions(df, model: str, stage: str):
    hits = [_hits(words) for words in RULES[(model, stage)]]
    total = reduce(lambda a, b: a + b, hits) + 4
    tokens = df.select("doc_id", F.col("lang").alias("label"), matches(F.lower("text"), r"[\p{L}\p{N}_]+").alias("t"))
    scored = tokens.select("doc_id", "label", F.array(*[(h + 1).cast("double") / total for h in hits]).alias("probability"))
    return scored.select(F.lit(model).alias("model"), F.lit(stage).alias("stage"), "doc_id", "label", "probability",
                         classify.predicted_class(F.col("probability"), CLASSES).alias("prediction"))


def _hits(words):
    return F.size(F.filter("t", lambda w: w.isin(words)))


def rule_sql(model: str, stage: str) -> str:
    hits = [f"len(list_filter(t, lambda w: w IN ({in_list(ws)})))" for ws in RULES[(model, stage)]]
    total = f"({' + '.join(hits)} + 4)"
    p = ", ".join(f"CAST({h} + 1 AS DOUBLE) / {total}" for h in hits)
    return f"""SELECT '{model}' AS model, '{stage}' AS stage, doc_id, label, p,
  ([{in_list(CLASSES)}])[list_position(p, list_max(p))] AS prediction
  FROM (SELECT doc_id, label, [{p}] AS p FROM (SELECT doc_id, lang AS label, {DOC_TOKENS} AS t FROM documents))"""


def preds(spark, sf, model="five", stage="initial"):
    return rule_predictions(docs(spark, sf), model, stage)


def all_preds(spark, sf):
    d = docs(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), [rule_predictions(d, m, st) for m, st in RULES])


P = f"pr AS ({rule_sql('five', 'initial')})"
ALL = "pr AS (" + " UNION ALL ".join(rule_sql(m, st) for m, st in RULES) + ")"
KLASS = f"k AS (SELECT unnest([{in_list(CLASSES)}]) AS class)"


def metrics_cte(keys: str = "") -> str:
    """Class counts and metrics per key from ``pr``."""
    ks = f"{keys}, " if keys else ""
    by = f" GROUP BY {ks}class"
    return f"""{KLASS},
cc AS (SELECT {ks}class, count(*) FILTER (label = class AND prediction = class) AS tp,
  count(*) FILTER (label <> class AND prediction = class) AS fp, count(*) FILTER (label = class AND prediction <> class) AS fn,
  count(*) FILTER (label <> class AND prediction <> class) AS tn FROM pr, k{by}),
cm AS (SELECT *, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall,
  coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1, coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0) AS specificity,
  tp + fn AS support FROM cc),
wm AS (SELECT {ks}sum(tp) / CAST(sum(support) AS DOUBLE) AS accuracy, sum(precision * support) / sum(support) AS precision,
  sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1 FROM cm{' GROUP BY ' + keys if keys else ''})"""


def rounded(names) -> str:
    return ", ".join(f"{r(n)} AS {n}" for n in names)


M = ["accuracy", "precision", "recall", "f1"]


@query("e01_accuracy", f"WITH {P} SELECT {r('avg(CAST(label = prediction AS INT))')} AS accuracy FROM pr")
def _(spark, sf):
    return tidy(e.accuracy(preds(spark, sf)))


@query("e02_weighted_metrics", f"WITH {P}, {metrics_cte()} SELECT {rounded(M)} FROM wm")
def _(spark, sf):
    return tidy(e.weighted_metrics(preds(spark, sf)))


@query("e03_classification_report", f"""WITH {P}, {metrics_cte()}
SELECT class, {rounded(M[1:])}, CAST(support AS BIGINT) AS support FROM cm UNION ALL
SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM cm UNION ALL
SELECT 'weighted avg', {rounded(M[1:])}, (SELECT CAST(sum(support) AS BIGINT) FROM cm) FROM wm""")
def _(spark, sf):
    return tidy(e.classification_report(preds(spark, sf)))


CELLS = f"""{KLASS}, cells AS (SELECT a.class AS label, b.class AS prediction, (SELECT count(*) FROM pr WHERE pr.label = a.class AND pr.prediction = b.class) AS n
FROM k a, k b)"""


@query("e04_confusion_matrix", f"WITH {P}, {CELLS} SELECT * FROM cells")
def _(spark, sf):
    return tidy(e.confusion_matrix(preds(spark, sf)))


@query("e05_class_counts", f"WITH {P}, {metrics_cte()} SELECT class, tp, fp, fn, tn FROM cc")
def _(spark, sf):
    return tidy(e.class_counts(preds(spark, sf)))


@query("e06_class_metrics", f"WITH {P}, {metrics_cte()} SELECT class, {rounded(['precision', 'recall', 'f1', 'specificity'])}, support FROM cm")
def _(spark, sf):
    return tidy(e.class_metrics(preds(spark, sf)))


@query("e07_confused_pairs", f"""WITH {P}
SELECT least(label, prediction) AS class_a, greatest(label, prediction) AS class_b, count(*) AS n FROM pr
WHERE label <> prediction GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 3""")
def _(spark, sf):
    return tidy(e.confused_pairs(preds(spark, sf)))


@query("e08_error_rate", f"""WITH {P} SELECT CAST(count_if(label <> prediction) AS BIGINT) AS misclassified_count,
  {r('avg(CAST(label <> prediction AS INT))')} AS misclassification_rate FROM pr""")
def _(spark, sf):
    return tidy(e.error_rate(preds(spark, sf)))


@query("e09_error_cases", f"""WITH {P} SELECT doc_id, label AS true_label, prediction AS predicted_label, {r('list_max(p)')} AS confidence
FROM pr WHERE label <> prediction""")
def _(spark, sf):
    return tidy(e.error_cases(preds(spark, sf)))


@query("e10_error_patterns", f"WITH {P}, {CELLS} SELECT label || '->' || prediction AS pattern, n FROM cells WHERE label <> prediction")
def _(spark, sf):
    return tidy(e.error_patterns(preds(spark, sf)))


LONG = "sc AS (SELECT doc_id, unnest([" + in_list(CLASSES) + "]) AS class, unnest(p) AS score, label FROM pr)"


def roc_cte(keys: str) -> str:
    by, part = (f"{keys}, ", f"PARTITION BY {keys} ") if keys else ("", "")
    return f"""{LONG},
ti AS (SELECT {by}score AS threshold, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg FROM sc GROUP BY {by}score),
ro AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER ({part}) AS tp_all, sum(neg) OVER ({part}) AS fp_all
  FROM ti WINDOW w AS ({part}ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""


POINTS = f"{r('threshold')} AS threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps, {r('tps / CAST(tp_all AS DOUBLE)')} AS tpr, {r('fps / CAST(fp_all AS DOUBLE)')} AS fpr"
AREA = r("sum(neg * (2 * tps - pos) / CAST(2 AS DOUBLE)) / (any_value(tp_all) * any_value(fp_all))")


@query("e11_roc_points", f"WITH {P}, {roc_cte('class')} SELECT class, {POINTS} FROM ro")
def _(spark, sf):
    points = e.roc_points(e.class_scores(preds(spark, sf), CLASSES))
    return tidy(points.select("class", "threshold", "tps", "fps", "tpr", "fpr"))


@query("e11_roc_auc", f"WITH {P}, {roc_cte('class')} SELECT class, {AREA} AS auc FROM ro GROUP BY class")
def _(spark, sf):
    return tidy(e.roc_auc(e.roc_points(e.class_scores(preds(spark, sf), CLASSES))))


@query("e11_quality_auc", f"""
WITH ti AS (SELECT n_chars AS threshold, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg
  FROM documents JOIN labels USING (doc_id) GROUP BY n_chars),
ro AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tps, sum(pos) OVER () AS tp_all, sum(neg) OVER () AS fp_all FROM ti)
SELECT {AREA} AS auc FROM ro""")
def _(spark, sf):
    d = labelled(spark, sf).where("quality IS NOT NULL").join(docs(spark, sf).select("doc_id", "n_chars"), "doc_id")
    scores = d.select(F.col("n_chars").cast("double").alias("score"), F.col("quality").cast("long").alias("hit"))
    return tidy(e.roc_auc(e.roc_points(scores, keys=()), keys=()))


@query("e12_micro_auc", f"WITH {P}, {roc_cte('')} SELECT {AREA} AS auc FROM ro")
def _(spark, sf):
    return tidy(e.roc_auc(e.roc_points(e.class_scores(preds(spark, sf), CLASSES), keys=()), keys=()))


FOLDED = f"pr0 AS ({rule_sql('five', 'initial')}), pr AS (SELECT pr0.*, fold FROM pr0 JOIN {FOLDS} f USING (doc_id))"


def fold_metrics(spark, sf):
    p = preds(spark, sf)
    folds = stratified_folds(docs(spark, sf).select("doc_id", "lang"), label="lang").select("doc_id", "fold")
    return e.weighted_metrics(p.join(folds, "doc_id"), ["fold"])


LONG_M = "lm AS (" + " UNION ALL ".join(f"SELECT fold, '{m}' AS metric, {m} AS value FROM wm" for m in M) + ")"


@query("e13_cross_validation_summary", f"""WITH {FOLDED}, {metrics_cte('fold')}, {LONG_M},
s AS (SELECT metric, avg(value) AS mean, stddev_pop(value) AS std, count(*) AS n FROM lm GROUP BY metric)
SELECT metric, {r('mean')} AS mean, {r('std')} AS std, {r('mean - CAST(1.96 AS DOUBLE) * std / sqrt(n)')} AS ci_low,
  {r('mean + CAST(1.96 AS DOUBLE) * std / sqrt(n)')} AS ci_high FROM s""")
def _(spark, sf):
    return tidy(e.cross_validation_summary(fold_metrics(spark, sf)))


@query("e14_cross_validation_t_interval", f"""WITH {FOLDED}, {metrics_cte('fold')},
s AS (SELECT avg(f1) AS mean, stddev_pop(f1) AS std, stddev_samp(f1) AS sd, count(*) AS n FROM wm)
SELECT {r('mean')} AS mean, {r('std')} AS std, {r('mean - CAST(2.7764451 AS DOUBLE) * sd / sqrt(n)')} AS ci_low,
  {r('mean + CAST(2.7764451 AS DOUBLE) * sd / sqrt(n)')} AS ci_high FROM s""")
def _(spark, sf):
    return tidy(e.cross_validation_t_interval(fold_metrics(spark, sf)))


ROLES = f"""pr0 AS ({rule_sql('five', 'initial')}),
pr AS (SELECT pr0.*, round AS fold, CASE WHEN f.fold = round THEN 'val' ELSE 'train' END AS role
  FROM pr0 JOIN {FOLDS} f USING (doc_id), (SELECT unnest(range(0, 5)) AS round))"""


@query("e15_fold_role_metrics", f"WITH {ROLES}, {metrics_cte('fold, role')} SELECT fold, role, {rounded(M)} FROM wm")
def _(spark, sf):
    folds = expand_folds(stratified_folds(docs(spark, sf).select("doc_id", "lang"), label="lang")).select(
        "doc_id", F.col("round").alias("fold"), "role")
    return tidy(e.weighted_metrics(preds(spark, sf).join(folds, "doc_id"), ["fold", "role"]))


@query("e16_best_fold", f"WITH {FOLDED}, {metrics_cte('fold')} SELECT fold, {r('f1')} AS f1 FROM wm ORDER BY f1 DESC, fold LIMIT 1")
def _(spark, sf):
    return tidy(e.best_fold(fold_metrics(spark, sf)))


def _unpivot(source: str, key: str, names) -> str:
    return " UNION ALL ".join(f"SELECT {key.format(m=m)} AS name, CAST({m} AS DOUBLE) AS value FROM {source}" for m in names)


def bundle_sql() -> str:
    """Every section from the fragments of the single queries."""
    def section(name: str, cte: str, body: str) -> str:
        return f"SELECT '{name}' AS section, name, {r('value')} AS value FROM (WITH {cte} {body})"

    by_class = ("precision", "recall", "f1", "specificity")
    cv = " UNION ALL ".join(
        f"""SELECT '{m}:' || s AS name, CASE s WHEN 'mean' THEN a WHEN 'std' THEN d WHEN 'ci_low' THEN a - 1.96 * d / sqrt(k) ELSE a + 1.96 * d / sqrt(k) END AS value
        FROM (SELECT avg({m}) AS a, stddev_pop({m}) AS d, count(*) AS k FROM wm), (SELECT unnest(['mean', 'std', 'ci_low', 'ci_high']) AS s)""" for m in M)
    parts = [
        section("overall", f"{P}, {metrics_cte()}", _unpivot("wm", "'{m}'", M)),
        section("class", f"{P}, {metrics_cte()}", _unpivot("cm", "class || ':{m}'", by_class)),
        section("counts", P, "SELECT 'cases' AS name, CAST(count(*) AS DOUBLE) AS value FROM pr UNION ALL SELECT 'misclassified_count', CAST(count_if(label <> prediction) AS DOUBLE) FROM pr "
                "UNION ALL SELECT 'misclassification_rate', avg(CAST(label <> prediction AS INT)) FROM pr"),
        section("errors", f"{P}, {CELLS}", "SELECT label || '->' || prediction AS name, CAST(n AS DOUBLE) AS value FROM cells WHERE label <> prediction"),
        section("auc", f"{P}, {roc_cte('class')}", f"SELECT class AS name, {AREA} AS value FROM ro GROUP BY class"),
        section("auc", f"{P}, {roc_cte('')}", f"SELECT 'micro' AS name, {AREA} AS value FROM ro"),
        section("case", P, "SELECT doc_id || ':' || label || '->' || prediction AS name, list_max(p) AS value FROM pr WHERE label <> prediction"),
        section("fold", f"{FOLDED}, {metrics_cte('fold')}", _unpivot("wm", "fold || ':{m}'", M)),
        section("cross_validation", f"{FOLDED}, {metrics_cte('fold')}", cv),
    ]
    return " UNION ALL ".join(parts)


@query("e18_evaluation_bundle", bundle_sql())
def _(spark, sf):
    folds = stratified_folds(docs(spark, sf).select("doc_id", "lang"), label="lang").select("doc_id", "fold")
    return tidy(e.evaluation_bundle(preds(spark, sf).join(folds, "doc_id"), CLASSES, fold="fold"))


INITIAL = ALL.replace("pr AS (", "pr0 AS (", 1) + ", pr AS (SELECT * FROM pr0 WHERE stage = 'initial')"


def comparison(spark, sf):
    return e.compare_models(all_preds(spark, sf).where("stage = 'initial'"))


@query("e19_model_comparison", f"WITH {INITIAL}, {metrics_cte('model')} SELECT model, {rounded(M)} FROM wm")
def _(spark, sf):
    return tidy(comparison(spark, sf))


@query("e20_model_ranking", f"""WITH {INITIAL}, {metrics_cte('model')},
lm AS (SELECT model, 'accuracy' AS metric, accuracy AS value FROM wm UNION ALL SELECT model, 'f1', f1 FROM wm)
SELECT model, metric, {r('value')} AS value, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS rank FROM lm""")
def _(spark, sf):
    return tidy(e.rank_models(comparison(spark, sf)))


STAGED = f"{ALL}, {metrics_cte('model, stage')}"


def staged(spark, sf):
    return e.weighted_metrics(all_preds(spark, sf), ["model", "stage"])


@query("e22_tuning_gain", f"""WITH {STAGED}, lm AS ({" UNION ALL ".join(f"SELECT model, stage, '{m}' AS metric, {m} AS value FROM wm" for m in M)})
SELECT a.model, a.metric, {r('a.value')} AS initial, {r('b.value')} AS tuned, {r('b.value - a.value')} AS improvement
FROM lm a JOIN lm b ON a.model = b.model AND a.metric = b.metric AND a.stage = 'initial' AND b.stage = 'tuned'""")
def _(spark, sf):
    return tidy(e.tuning_gain(staged(spark, sf)))


@query("e23_best_model", f"""WITH {STAGED}
SELECT model AS model_type, stage = 'tuned' AS is_tuned, {r('f1')} AS f1, 'f1 (weighted)' AS metric_used
FROM wm ORDER BY wm.f1 DESC, stage <> 'tuned', model LIMIT 1""")
def _(spark, sf):
    return tidy(e.best_model(staged(spark, sf)))


FEATURES = ["n_chars", "n_words", "n_stops", "quality"]
FEATURE_ROWS = r"""(SELECT n_chars, len(regexp_extract_all(text, '[^ ]+')) AS n_words, len(regexp_extract_all(text, '[.]')) AS n_stops, quality
FROM documents JOIN labels USING (doc_id))"""


@query("e25_feature_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})')} AS correlation FROM {FEATURE_ROWS}"
    for i, a in enumerate(FEATURES) for b in FEATURES[i:]))
def _(spark, sf):
    d = labelled(spark, sf).where("quality IS NOT NULL").join(docs(spark, sf).select("doc_id", "n_chars"), "doc_id")
    rows = d.select("n_chars", F.regexp_count("text", F.lit("[^ ]+")).alias("n_words"),
                    F.regexp_count("text", F.lit("[.]")).alias("n_stops"), "quality")
    return tidy(e.feature_correlations(rows, FEATURES))
