"""Splits, folds, batches and label encoding: exact counts, reproducible, no global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.scale import hash_order, hash_rank, join_side, running_totals


def stratified_split(df: DataFrame, id: str = "doc_id", label: str = "label", test: float = 0.15, val: float = 0.15,
                     seed: int = 42) -> DataFrame:
    """Train / val / test with exact shares per class.

    ``val`` is a share of the whole and is taken from what the test set leaves,
    adjusted to ``val / (1 - test)``.
    """
    ranked = hash_rank(df.select(id, label), [label], id, seed)
    n, rank = F.col("rank_total"), F.col("rank")
    n_test = F.round(n * test)
    n_val = F.round((n - n_test) * (val / (1.0 - test)))
    return ranked.select(id, label, F.when(rank <= n_test, "test").when(rank <= n_test + n_val, "val")
                         .otherwise("train").alias("split"))


def split_bounds(df: DataFrame, id: str = "doc_id", label: str = "label", test: float = 0.15, val: float = 0.15,
                 seed: int = 42) -> DataFrame:
    """Per label the last digest of the test and of the validation part: the split in one row per class."""
    parts = stratified_split(df, id, label, test, val, seed).withColumn("digest", hash_order(F.col(id), seed))
    last = parts.groupBy(label).agg(F.max(F.when(F.col("split") == "test", F.col("digest"))).alias("t"),
                                    F.max(F.when(F.col("split") == "val", F.col("digest"))).alias("v"))
    test_end = F.coalesce("t", F.lit(""))
    return last.select(label, test_end.alias("test_end"), F.coalesce("v", test_end).alias("val_end"))


def add_split(df: DataFrame, id: str = "doc_id", label: str = "label", test: float = 0.15, val: float = 0.15,
              seed: int = 42) -> DataFrame:
    """The stratified split as a column on wide rows, which are not shuffled for it.

    Only ids and labels are ranked; each row then compares its own digest with the
    bounds of its class.
    """
    bounds = split_bounds(df.select(id, label), id, label, test, val, seed)
    digest = hash_order(F.col(id), seed)
    split = F.when(digest <= F.col("test_end"), "test").when(digest <= F.col("val_end"), "val").otherwise("train")
    return join_side(df, bounds, label, "left").select(*df.columns, split.alias("split"))


def stratified_folds(df: DataFrame, id: str = "doc_id", label: str = "label", k: int = 5, seed: int = 42) -> DataFrame:
    """Fold 0..k-1 per document, classes spread evenly."""
    ranked = hash_rank(df.select(id, label), [label], id, seed)
    return ranked.select(id, label, ((F.col("rank") - 1) % k).cast("int").alias("fold"))


def plain_folds(df: DataFrame, id: str = "doc_id", k: int = 5, seed: int = 42) -> DataFrame:
    """Fold 0..k-1 per document, sizes equal up to one."""
    ranked = hash_rank(df.select(id), [], id, seed)
    return ranked.select(id, ((F.col("rank") - 1) % k).cast("int").alias("fold"))


def expand_folds(folded: DataFrame, k: int = 5, fold: str = "fold") -> DataFrame:
    """Each document once per round: ``val`` in its own fold, ``train`` in the others."""
    rounds = folded.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return rounds.withColumn("role", F.when(F.col(fold) == F.col("round"), "val").otherwise("train"))


def batches(df: DataFrame, size: int, id: str = "doc_id", shuffle: bool = True, seed: int = 42) -> DataFrame:
    """Batch number per document; all batches hold ``size`` documents but the last.

    Shuffled order is the hash order, otherwise the order of the ids.
    """
    if shuffle:
        ranked = hash_rank(df, [], id, seed)
    else:
        ranked = running_totals(df, [], [F.asc(id)], {"rank": F.lit(1)})
    index = F.col("rank") - 1
    return ranked.withColumn("batch_id", F.floor(index / size).cast("long")).drop("rank", "rank_total")


def split_rows(df: DataFrame, split: str, column: str = "split") -> DataFrame:
    """One split; on a table partitioned by split only its folder is read."""
    return df.where(F.col(column) == split)


def label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """Sorted distinct labels with their index from 0."""
    labels = df.select(label).where(F.col(label).isNotNull()).distinct()
    ordered = labels.agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return ordered.select(F.posexplode("labels").alias("label_index", label)).select(
        label, F.col("label_index").cast("double"))


def encode_labels(df: DataFrame, index: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_index``; a label the index does not know is an error."""
    coded = join_side(df, index, label, "left")
    unknown = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(F.col(label), F.lit("NULL"))))
    return coded.withColumn("label_index", F.coalesce("label_index", unknown.cast("double")))


def decode_labels(df: DataFrame, index: DataFrame, column: str = "prediction", label: str = "label") -> DataFrame:
    """Add the label of an index column as ``predicted_label``."""
    back = index.select(F.col("label_index").alias(column), F.col(label).alias("predicted_label"))
    return join_side(df, back, column, "left")


def binarize_labels(df: DataFrame, classes: list[str], id: str = "doc_id", label: str = "label") -> DataFrame:
    """One 0/1 column per class, for one-against-rest work."""
    return df.select(id, *[(F.col(label) == c).cast("int").alias(f"is_{c}") for c in classes])


def training_table_report(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Rows, classes, missing labels and non-finite cells, in one pass."""
    bad: Column = sum(((F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
                        | F.abs(F.col(c).cast("double")).eqNullSafe(float("inf"))).cast("long") for c in features),
                      F.lit(0))
    return df.agg(F.count("*").alias("rows"), F.count_distinct(label).alias("classes"),
                  F.count_if(F.col(label).isNull()).alias("missing_labels"),
                  F.coalesce(F.sum(bad), F.lit(0)).alias("bad_values"))


def validate_training_table(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Raise ``ValueError`` unless labels are complete, features finite and two classes present."""
    missing = [c for c in [*features, label] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    row = training_table_report(df, features, label).first()
    if row["rows"] == 0 or row["missing_labels"] or row["bad_values"] or row["classes"] < 2:
        raise ValueError(f"not a training table: {row.asDict()}")
    return df


