"""Split, fold, batch and label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import splits as s
from registry.common import docs, labelled, query, tidy


def ranked(keys: str = "", seed: int = 42) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    order = f"ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':{seed}')), doc_id"
    return f"""(SELECT doc_id, lang, row_number() OVER ({part}{order}) AS rank,
  count(*) OVER ({part}) AS n FROM documents)"""


def base(spark, sf):
    return docs(spark, sf).select("doc_id", "lang")


SPLIT = f"""(SELECT doc_id, lang, CASE WHEN rank <= t THEN 'test' WHEN rank <= t + round((n - t) * (0.15 / 0.85)) THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, round(n * CAST(0.15 AS DOUBLE)) AS t FROM {ranked('lang')}))"""


@query("d01_stratified_split", f"SELECT * FROM {SPLIT}")
def _(spark, sf):
    return s.stratified_split(base(spark, sf), label="lang")


@query("d01_split_column", f"SELECT s.doc_id, s.lang, text, split FROM {SPLIT} s JOIN documents USING (doc_id)")
def _(spark, sf):
    return s.add_split(docs(spark, sf).select("doc_id", "lang", "text"), label="lang")


@query("d01_split_missing_labels", """
WITH b AS (SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM documents LEFT JOIN labels USING (doc_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) AS rank, count(*) OVER (PARTITION BY quality) AS n FROM b),
t AS (SELECT *, round(n * CAST(0.15 AS DOUBLE)) AS t FROM k)
SELECT doc_id, quality, CASE WHEN rank <= t THEN 'test' WHEN rank <= t + round((n - t) * (0.15 / 0.85)) THEN 'val' ELSE 'train' END AS split FROM t""")
def _(spark, sf):
    return tidy(s.add_split(labelled(spark, sf).select("doc_id", "quality"), label="quality"))


@query("d02_label_encoding", """
WITH i AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label_index FROM (SELECT DISTINCT lang FROM documents))
SELECT doc_id, lang, label_index, lang AS predicted_label FROM documents JOIN i USING (lang)""")
def _(spark, sf):
    d = base(spark, sf)
    index = s.label_index(d, "lang")
    return s.decode_labels(s.encode_labels(d, index, "lang"), index, "label_index", "lang")


FOLDS = f"(SELECT doc_id, lang, CAST((rank - 1) % 5 AS BIGINT) AS fold FROM {ranked('lang')})"


@query("d03_stratified_folds", f"SELECT * FROM {FOLDS}")
def _(spark, sf):
    return tidy(s.stratified_folds(base(spark, sf), label="lang"))


@query("d04_plain_folds", f"SELECT doc_id, CAST((rank - 1) % 5 AS BIGINT) AS fold FROM {ranked()}")
def _(spark, sf):
    return tidy(s.plain_folds(base(spark, sf)))


@query("d05_fold_expansion", f"""
SELECT doc_id, lang, fold, round, CASE WHEN fold = round THEN 'val' ELSE 'train' END AS role
FROM {FOLDS}, (SELECT unnest(range(0, 5)) AS round)""")
def _(spark, sf):
    return tidy(s.expand_folds(s.stratified_folds(base(spark, sf), label="lang")))


@query("d06_shuffled_batches", f"SELECT doc_id, lang, CAST(floor((rank - 1) / 32) AS BIGINT) AS batch_id FROM {ranked()}")
def _(spark, sf):
    return tidy(s.batches(base(spark, sf), 32))


@query("d06_ordered_batches", """
SELECT doc_id, lang, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 32) AS BIGINT) AS batch_id FROM documents""")
def _(spark, sf):
    return tidy(s.batches(base(spark, sf), 32, shuffle=False))


@query("d07_split_rows", f"SELECT doc_id, lang, split FROM {SPLIT} WHERE split = 'val'")
def _(spark, sf):
    return s.split_rows(s.stratified_split(base(spark, sf), label="lang"), "val")


CLASSES = ["de", "en", "es", "fr"]


@query("d08_binarized_labels", "SELECT doc_id, " + ", ".join(f"CAST(lang = '{c}' AS BIGINT) AS is_{c}" for c in CLASSES) + " FROM documents")
def _(spark, sf):
    return tidy(s.binarize_labels(base(spark, sf), CLASSES, label="lang"))


@query("d09_training_table_report", """
SELECT count(*) AS rows, count(DISTINCT quality) AS classes, CAST(count_if(quality IS NULL) AS BIGINT) AS missing_labels,
  CAST(count_if(toxic IS NULL) + count_if(ratio IS NULL OR isnan(ratio) OR isinf(ratio)) AS BIGINT) AS bad_values
FROM (SELECT quality, toxic, CAST(toxic AS DOUBLE) / nullif(quality, 0) AS ratio FROM documents LEFT JOIN labels USING (doc_id))""")
def _(spark, sf):
    d = labelled(spark, sf).withColumn("ratio", F.col("toxic").cast("double") / F.nullif("quality", F.lit(0)))
    return tidy(s.training_table_report(d, ["toxic", "ratio"], "quality"))
