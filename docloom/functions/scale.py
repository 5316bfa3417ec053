"""Building blocks that keep a plan safe when one key holds much of the data."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from docloom.session import ensure_checkpoints, shared_folder

SIDE_BYTES = 32 << 20


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def write_side(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder as Parquet; the optimizer then knows its size from its files."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/docloom/{df.sparkSession.sparkContext.applicationId}/side-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Size of a table as the optimizer estimates it; exact for tables in files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_side(big: DataFrame, side: DataFrame, on: str | Sequence[str], how: str = "inner",
              max_bytes: int = SIDE_BYTES) -> DataFrame:
    """Join an aggregate (one row per key, NULL a key like others) to the rows it came from.

    The side is computed once, written, and broadcast when its files are within the
    bound; a larger one is shuffled, where adaptive execution splits hot keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("the side can only be the optional one")
    keys = [on] if isinstance(on, str) else list(on)
    side = write_side(side)
    named = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys]
    joined = big.join(F.broadcast(named) if plan_bytes(side) <= max_bytes else named, same, how)
    return joined.drop(*[f"_side_{k}" for k in keys])


def hot_join(big: DataFrame, side: DataFrame, on: str, count: str, how: str = "inner") -> DataFrame:
    """Equi join on a string key whose frequency in ``big`` is known: ``side`` has one row per key and its ``count``.

    Keys with more than one part in ``partitions`` of all rows are fewer than there are partitions, so they are broadcast;
    their rows then get keys of their own, which spread them, and the others are shuffled plainly. Nothing is repeated.
    """
    if how not in ("inner", "left"):
        raise ValueError("the side can only be the optional one")
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = write_side(side)
    bound = side.agg(F.sum(count)).scalar() / F.lit(float(partitions))
    values = [c for c in side.columns if c != on]
    packed = F.struct(*[F.col(v) for v in values])
    hot = side.where(F.col(count) > bound).select(on, packed.alias("_hot"))
    rest = side.where(F.col(count) <= bound).select(F.col(on).alias("_key"), packed.alias("_rest"))
    met = big.join(F.broadcast(hot), on, "left")
    own = F.concat(F.lit("\0"), F.xxhash64(*big.columns).cast("string"))
    met = met.withColumn("_key", F.when(F.col("_hot").isNotNull(), own).otherwise(F.col(on))).join(rest, "_key", "left")
    met = met.withColumn("_side", F.coalesce("_hot", "_rest"))
    if how == "inner":
        met = met.where(F.col("_side").isNotNull())
    return met.select(*big.columns, *[F.col(f"_side.{v}").alias(v) for v in values])


#: Values a broadcast of frequent keys holds at most, 32 MB of doubles.
FREQUENT_VALUES = 4 << 20


def frequent_join(big: DataFrame, side: DataFrame, on: str, count: str, most: int) -> DataFrame:
    """Inner equi join of rows to ``side`` with one row per key and its ``count`` in ``big``: the ``most`` most frequent keys are broadcast.

    Their rows stay where they are, next to those of the same document; only rows of the other keys are shuffled. Keys of equal count are broadcast together or
    not at all. Both tables are read more than once, so they should be written ones.
    """
    levels = side.groupBy(count).agg(F.count("*").alias("_keys"))
    upto = F.sum("_keys").over(Window.orderBy(F.desc(count)))
    bound = levels.select(count, upto.alias("_upto")).where(F.col("_upto") <= most).agg(F.min(count)).scalar()
    hot = side.where(F.col(count) >= bound)
    rest = big.join(F.broadcast(hot.select(on)), on, "left_anti").join(side.where(F.coalesce(F.col(count) < bound, F.lit(True))), on)
    return big.join(F.broadcast(hot), on).unionByName(rest)


def hash_order(id_col: Column, seed: int) -> Column:
    """Reproducible pseudo-random order of rows: hex digest of id and seed."""
    return F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}")))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, Column],
                   slice_by: Column | None = None) -> DataFrame:
    """Cumulative sums over ``order`` within ``keys``, with no group in a single task.

    Adds per entry of ``sums`` the inclusive running value ``name`` and the group
    total ``name_total``. The order is cut into slices, whose totals give each
    slice its starting value; the window then runs inside one slice. ``slice_by``
    must rise with the order (a hash prefix does). Without it the rows are range
    partitioned on keys and order, and settled, so that both uses see one layout.

    The starting value enters as an extra first row of its slice, which saves a
    join and keeps NULL keys.
    """
    keys = list(keys)
    added = {name: f"_add_{name}" for name in sums}
    rows = df.select("*", *[c.alias(added[n]) for n, c in sums.items()])
    if slice_by is None:
        ranged = rows.repartitionByRange(*[F.col(k) for k in keys], *order)
        rows = settle(ranged.withColumn("_slice", F.spark_partition_id()))
    else:
        rows = rows.withColumn("_slice", slice_by)

    per_slice = rows.groupBy(*keys, "_slice").agg(*[F.sum(a).alias(a) for a in added.values()])
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        *keys, "_slice", F.lit(0).alias("_row"),
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(a) for a in added.values()],
        *[F.sum(a).over(group).alias(f"{n}_total") for n, a in added.items()],
    )
    within = Window.partitionBy(*keys, "_slice")
    upto = within.orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.withColumn("_row", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    out = both.select(
        *[F.col(c) for c in df.columns], "_row",
        *[F.sum(a).over(upto).alias(n) for n, a in added.items()],
        *[F.max(f"{n}_total").over(within).alias(f"{n}_total") for n in sums],
    )
    return out.where("_row = 1").drop("_row")


def slice_digits(df: DataFrame) -> int:
    """Hex digits that cut a table of this size into slices of about a megabyte, two at least."""
    return max(2, math.ceil(math.log(max(1, plan_bytes(df) >> 16), 16)))


def hash_rank(df: DataFrame, keys: Sequence[str], id_col: str, seed: int) -> DataFrame:
    """Exact rank ``rank`` (1-based) and group size ``rank_total`` in hash order within ``keys``.

    The digest is uniform, so its leading digits cut even one huge group into
    like-sized slices; their number grows with the size of the table.
    """
    digest = hash_order(F.col(id_col), seed)
    hashed = df.withColumn("_digest", digest)
    ranked = running_totals(hashed, keys, [F.col("_digest"), F.col(id_col)], {"rank": F.lit(1)},
                            slice_by=F.substring("_digest", 1, slice_digits(df)))
    return ranked.drop("_digest")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group; Spark keeps only ``k`` per task before it shuffles."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)
