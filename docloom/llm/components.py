"""Connected components by rounds of joins: nobody holds the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import settle


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` for every node of ``edges`` (``u, v``, longs): the label is the smallest node of its component.

    Each round gives every node the smallest label around it and then follows labels one step (pointer jumping), so
    the number of rounds grows with the logarithm of a component's diameter. A node with very many edges is a partial minimum per task.
    """
    both = settle(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), f"{name}-edges")
    labels = settle(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).select(F.col("u").alias("node"), "label"), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        around = (both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("near")), "v")
                  .groupBy("u").agg(F.min("near").alias("near")).select(F.col("u").alias("node"), "near"))
        hopped = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = hopped.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = settle(hopped.join(roots, "label", "left").select("node", "old", F.least("label", F.coalesce("root", "label")).alias("label")),
                        f"{name}-{turn}")
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels
