"""What the operators of this subpackage share: settled tables, guarded broadcasts, ranks and a bounded memo."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docloom.session import shared_folder, ship  # noqa: F401

#: Separator class of the word definition ``[^\x20\x09-\x0D]+``, as a Java pattern.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A side is broadcast only when the Parquet files it was written to stay below this. Decoded rows take up to six times as much (measured), so some 100 MB.
BROADCAST_BYTES = 16 << 20


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh folder in ``spark.checkpoint.dir``, which all executors reach."""
    return f"{shared_folder(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    A lost executor then costs one task of a scan, not the work before it, and
    values such as ``monotonically_increasing_id`` never change again.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Size of a settled table as the optimizer knows it from its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def guarded(side: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``side``, a settled table, marked for broadcast if its files are small; else left to a shuffled join."""
    return F.broadcast(side) if plan_bytes(side) <= limit else side


def blank_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for null or blank text."""
    squeezed = F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")
    return F.when(F.length(squeezed) > 0, F.split(squeezed, f"{BLANK}+")).otherwise(F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dense_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int) -> DataFrame:
    """Adds ``name``: the gapless position from 0 of each row within ``keys``, in the order of ``_slice`` and ``order``.

    ``df`` carries ``_slice``, a number below ``slices`` that rises with the wanted
    order. Windows run inside one slice of one key, and the slice totals, one row
    per key and slice, give each slice its start; no group is in one task.
    """
    counts = df.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.lit(0).alias("_row"))
    within = Window.partitionBy(*keys, "_slice").orderBy("_row", *order)
    both = df.withColumn("_row", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    ranked = both.withColumn(name, F.max("_start").over(within.rowsBetween(Window.unboundedPreceding, 0))
                             + F.row_number().over(within) - 2)
    return ranked.where("_row = 1").drop("_row", "_start", "_slice")


class Memo(dict):
    """A dictionary of bounded size for values that can be computed again.

    When it is full, entries move to a second generation, and what was there and
    not asked for since is forgotten. Bounds memory only; results never depend on it.
    """

    def __init__(self, compute: Callable, size: int = 300_000):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
