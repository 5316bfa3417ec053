"""Exact dedup (operator 6).

Method: tree-merge of sorted digest runs. Every input partition makes a run: its distinct digests in order, each with
its smallest document and its count. In binomial rounds, the runs whose numbers differ only in the lowest ``FAN_BITS``
bits go to one place and are merged, several at a time; each level keeps the smallest identifier per digest. The digest
space is cut into lanes with a tree each, so that the root of no tree is large, and a group of copies with a third of
all rows is one row per run from the first level on. Native: DataFrame functions only.

Two texts are equal when identical after each ``[\\x20\\x09-\\x0D]+`` became one space. An identifier is verified at every
level: a digest is the SHA-256 of that text with its length and a second hash of another family, and a run entry
is merged only if all three agree.

Defined cases: null text counts as empty, so all null, empty (not: blank) texts are one group; a null ``doc_id`` comes
after all others; of rows with the same text and ``doc_id`` exactly one stays; an empty table gives no rows; columns of
``docs`` whose names clash with the result are not taken along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import BLANK, blank_text, guarded, settle

FAN_BITS = 3
KEY = ["sha", "len", "alt"]


def normalised(text: str = "text"):
    return F.regexp_replace(blank_text(text), f"{BLANK}+", " ")


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, a row number ``rid`` and the digest (``sha`` binary, ``len``, ``alt``), settled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(text).alias("t"))
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.unhex(F.sha2("t", 256)).alias("sha"),
                       F.octet_length("t").alias("len"), F.xxhash64("t").alias("alt"))
    return settle(rows, "digests")


def merge_runs(rows: DataFrame, lanes: int | None = None, fan_bits: int = FAN_BITS) -> DataFrame:
    """Root of the trees: per digest ``keep_id``, ``keep_rid`` and ``group_size``. A column ``tie`` decides between rows of one ``doc_id``."""
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = lanes or width
    # rid is monotonically_increasing_id: its upper bits number the input partition
    first = F.shiftright("rid", 33)
    runs = rows.withColumn("run", first).withColumn("lane", F.pmod("alt", F.lit(lanes)))
    ties = [F.col("tie")] if "tie" in rows.columns else []
    best = F.struct(F.col("doc_id").isNull().alias("null_id"), F.col("doc_id"), *ties, F.col("rid"))
    level = runs.groupBy("lane", "run", *KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    most = rows.select(F.max(first)).first()[0] or 0
    while most > 0:
        most >>= fan_bits
        level = (level.withColumn("run", F.shiftright("run", fan_bits))
                 .repartition(width, "lane", "run").sortWithinPartitions("lane", "run", *KEY)
                 .groupBy("lane", "run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n")))
    return level.select(*KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"),
                        F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Only digests of two and more rows are joined back, so that single texts meet no partner; adaptive execution splits a group that holds much of the rows.
    """
    rows = digests(docs, text)
    groups = settle(merge_runs(rows).where("group_size > 1"), "copies")
    return rows.join(groups, KEY, "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; columns unchanged.

    Documents are written with their digests and row numbers; the dropped row numbers are found on the narrow columns and meet the documents by
    broadcast while their table is small, else in one shuffle. Of several rows with one text and one ``doc_id``, the one with the smallest hash
    of all columns stays.
    """
    t = normalised(text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = settle(docs.select(row.alias("_row"), F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                               F.unhex(F.sha2(t, 256)).alias("sha"), F.octet_length(t).alias("len"), F.xxhash64(t).alias("alt"),
                               F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie")), "digested-documents")
    rows = named.drop("_row")
    groups = settle(merge_runs(rows).where("group_size > 1"), "copies")
    lost = settle(rows.join(groups, KEY).where("rid <> keep_rid").select("rid"), "lost")
    return named.join(guarded(lost), "rid", "left_anti").select("_row.*")
