"""Mixing sources to target weights (operator 2).

Method: Sainte-Lague apportionment. The mix is counted in blocks of equal many words. All blocks are dealt to the sources
by highest quotients ``target / (2 k + 1)``; each source's blocks are then dealt in the same way to its shards, by the shards'
words. A shard is a part of a source chosen by a hash of ``doc_id``, small enough for one task; a source with a third of all
rows has as many more shards. Within a shard the documents lie in seeded random order on a line, and the shard's quota of
blocks is taken from the line's start, again from the start when it ends: so each document is taken a whole number of times,
but for the one in which the last block ends.

Defined cases: null text has size 0 and is never taken; null sources are one source, last in order; a null ``doc_id`` is a value
like any other; repeated rows are documents of their own; without any words every target is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from docloom.llm.common import BLANK, WORD, blank_text, guarded, settle

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 16
SHARD_ROWS = 2_000
SHARD_WORDS = 2_000_000
CELL = ["_source", "_shard"]


def size_of(text: str = "text"):
    return F.regexp_count(blank_text(text), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (``source``, ``source_size``, one row each) with ``weight`` and ``target``.

    Weights repeat over the sources by code point, null last. All sources share ``share`` of all words by weight; none takes
    more than ``most`` times its own. In order of ``most * size / weight``, sources are full as long as their part of what is left at that
    point, by the weights left, is no less than their limit; the rest divide what is left.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_k"), F.lit(len(weights))) + 1).cast("int"))
    w = sources.withColumn("_k", F.row_number().over(order) - 1).withColumn("weight", pick)
    w = w.withColumn("_cap", F.lit(most) * F.col("source_size"))
    rise = Window.orderBy(F.col("_cap") / F.col("weight"), "_k")
    upto = rise.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = (w.withColumn("_left", F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
         .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
         .withColumn("_level", F.col("_left") / F.col("_weights")))
    # the level at which the first source that is not full stands holds for it and all after it
    full = F.col("_cap") <= F.col("_level") * F.col("weight")
    w = w.withColumn("_full", full).withColumn("_open", F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("weight"), "_k", "_level"))).over(everything))
    return w.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_open._level") * F.col("weight"))) \
        .select("source", "source_size", "weight", "target")


def apportion(cells: DataFrame, group: Sequence[str], votes: str, seats: str, out: str, order: Sequence[str]) -> DataFrame:
    """Sainte-Lague: adds ``out``, the number of ``seats`` (same in the whole group) that each cell gets for its ``votes``.

    The seat ``k`` (from 0) of a cell has the quotient ``votes / (2 k + 1)``; the ``seats`` highest of a group win, ties by ``order``.
    With divisor ``d``, the quotients above it number ``floor(votes / d + 1/2)``. A divisor for ``seats - n`` seats, ``n`` cells in the group, gives
    seats that are all won, one for ``seats + n`` covers all winners; only the quotients in between, a few per cell, are ranked.
    """
    whole = Window.partitionBy(*group)
    c = cells.withColumn("_votes", F.sum(votes).over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
    seats_at = lambda s: F.when(F.col("_votes") > 0, F.floor(F.col(votes) * s / F.col("_votes") + 0.5)).otherwise(0).cast("long")
    c = (c.withColumn("_low", seats_at(F.greatest(F.col(seats) - F.col("_n"), F.lit(0))))
         .withColumn("_high", seats_at(F.col(seats) + F.col("_n")))
         .withColumn("_won", F.sum("_low").over(whole)))
    steps = F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1)).otherwise(F.array(F.lit(None).cast("long")))
    tried = c.withColumn("_k", F.explode(steps))
    best = Window.partitionBy(*group).orderBy(F.col("_quotient").desc_nulls_last(), *order, "_k")
    ranked = (tried.withColumn("_quotient", F.col(votes) / (2 * F.col("_k") + 1)).withColumn("_rank", F.row_number().over(best))
              .withColumn("_wins", (F.col("_k").isNotNull() & (F.col("_rank") <= F.col(seats) - F.col("_won"))).cast("long")))
    return ranked.groupBy(*cells.columns).agg((F.max("_low") + F.sum("_wins")).alias(out))


def shard_quotas(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17,
                 block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """For ``sized`` (settled rows with ``doc_id``, ``source``, ``size``): a table of the sources with their shards, and one of the shards with the words ``_take`` they give."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    totals = settle(totals, "mix-sources")
    aimed = targets(totals, weights, share, most).withColumn("_all", F.lit(0))
    blocks = F.round(F.sum("target").over(Window.partitionBy("_all")) / block_words).cast("long")
    dealt = apportion(aimed.withColumn("_seats", blocks), ["_all"], "target", "_seats", "_blocks",
                      [F.col("source").isNull(), F.encode("source", "utf-8")])
    dealt = dealt.select(F.col("source").alias("_source"), "target", "_blocks")
    joined = totals.join(dealt, F.col("source").eqNullSafe(F.col("_source")), "left")
    shards = F.ceil(F.greatest(F.col("_rows") / SHARD_ROWS, F.col("source_size") / SHARD_WORDS, F.lit(1.0))).cast("long")
    side = settle(joined.select(F.struct("source").alias("_key"), "source_size", "target", "_blocks", shards.alias("_shards")), "mix-targets")

    cells = in_shards(sized, side, seed).groupBy(*CELL).agg(F.sum("size").alias("_words"), F.first("_blocks").alias("_blocks"))
    quotas = apportion(cells, ["_source"], "_words", "_blocks", "_quota", ["_shard"])
    # no shard gives more than ``most`` times its words
    quotas = quotas.select(*CELL, "_words", F.least(F.col("_quota") * block_words, F.floor(most * F.col("_words"))).cast("long").alias("_take"))
    return side, settle(quotas, "mix-quotas")


def in_shards(rows: DataFrame, side: DataFrame, seed: int) -> DataFrame:
    """``rows`` (``doc_id``, ``source``) with their cell and what ``side`` knows of their source."""
    rows = rows.withColumn("_source", F.struct("source")).join(guarded(side.withColumnRenamed("_key", "_source")), "_source", "left")
    return rows.withColumn("_shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("_shards")))


def rounds_and_rest():
    """How often a shard's line is taken as a whole, and the words taken once more from its start."""
    rounds = F.when(F.col("_words") > 0, F.floor(F.col("_take") / F.col("_words"))).otherwise(0).cast("long")
    return rounds, F.col("_take") - rounds * F.col("_words")


def plan_mix(sized: DataFrame, seed: int = 17, **options) -> DataFrame:
    """``sized`` (settled rows with ``doc_id``, ``source``, ``size``) with ``source_size``, ``target`` and ``taken``."""
    side, quotas = shard_quotas(sized, seed=seed, **options)
    line = Window.partitionBy(*CELL).orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_shards(sized, side, seed).withColumn("_at", F.coalesce(F.sum("size").over(line), F.lit(0))).join(guarded(quotas), CELL)
    rounds, rest = rounds_and_rest()
    part = F.least(F.col("size"), F.greatest(rest - F.col("_at"), F.lit(0)))
    return placed.withColumn("taken", (rounds * F.col("size") + part).cast("long")).drop(
        *CELL, "_blocks", "_shards", "_words", "_take", "_at")


def line_cuts(sized: DataFrame, side: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """One row per shard: its ``_rounds`` and ``_rest``, and the place on its line (``_cut``) where the rest ends.

    Rows of one place (same ``doc_id`` and ``size``) are counted together: ``_from`` is where they start, ``_same`` their number.
    """
    hashed = in_shards(sized, side, seed).withColumn("_hash", F.xxhash64("doc_id", F.lit(seed + 1)))
    places = hashed.groupBy(*CELL, "_hash", "doc_id", "size").agg(F.count(F.lit(1)).alias("_same"))
    line = Window.partitionBy(*CELL).orderBy("_hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rounds, rest = rounds_and_rest()
    placed = places.withColumn("_from", F.coalesce(F.sum(F.col("size") * F.col("_same")).over(line), F.lit(0))).join(guarded(quotas), CELL)
    placed = placed.select(*CELL, rounds.alias("_rounds"), rest.alias("_rest"), F.struct(F.col("_hash").alias("h"), F.col("doc_id").alias("d"), F.col("size").alias("s")).alias("_place"),
                           "_from", "_same", (F.col("_from") + F.col("size") * F.col("_same")).alias("_to"))
    first = F.min(F.when(F.col("_to") > F.col("_rest"), F.struct("_place", "_from", "_same")))
    cuts = placed.groupBy(*CELL, "_rounds", "_rest").agg(first.alias("_first"))
    return settle(cuts.select(*CELL, "_rounds", "_rest", F.col("_first._place").alias("_cut"), F.col("_first._from").alias("_from"), F.col("_first._same").alias("_same")), "mix-cuts")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``."""
    sized = settle(docs.select("doc_id", "source", size_of().alias("size")), "mix-sizes")
    return plan_mix(sized, **options)


def mixed_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: whole copies, and the words up to the last block's end of the document it ends in.

    A document that is not taken is left out. ``n_chars`` is that of the text given. Only ids and sizes are written and shuffled: a document
    finds what is taken of it by its place against the cut of its shard's line, one row per shard.
    """
    sized = settle(docs.select("doc_id", "source", size_of().alias("size")), "mix-sizes")
    side, quotas = shard_quotas(sized, seed=seed, **options)
    cuts = line_cuts(sized, side, quotas, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = in_shards(docs.select(row, "doc_id", "source", size_of().alias("_size")), side.select("_key", "_shards"), seed).join(guarded(cuts), CELL)
    place = F.struct(F.xxhash64("doc_id", F.lit(seed + 1)).alias("h"), F.col("doc_id").alias("d"), F.col("_size").alias("s"))
    rows = rows.withColumn("_order", F.when(place < F.col("_cut"), -1).when(place == F.col("_cut"), 0).otherwise(1)).withColumn("_before", F.lit(0).cast("long"))
    if not cuts.where("_same > 1").isEmpty():
        # rows of one place that a cut goes through are told apart by their texts
        same = Window.partitionBy(*CELL).orderBy(F.xxhash64("_row.text"))
        at_cut = (F.col("_order") == 0) & (F.col("_same") > 1)
        rows = rows.where(~at_cut).unionByName(rows.where(at_cut).withColumn("_before", (F.row_number().over(same) - 1).cast("long")))
    left = F.col("_rest") - F.col("_from") - F.col("_before") * F.col("_size")
    part = F.when(F.col("_order") < 0, F.col("_size")).when(F.col("_order") == 0, F.least(F.col("_size"), F.greatest(left, F.lit(0)))).otherwise(0)
    rows = rows.where("_size > 0").withColumn("taken", (F.col("_rounds") * F.col("_size") + part).cast("long")).where("taken > 0")
    copies = F.floor(F.col("taken") / F.col("_size"))
    rest = F.col("taken") % F.col("_size")
    rows = rows.withColumn("_part", F.explode(F.sequence(F.lit(1).cast("long"), copies + F.when(rest > 0, 1).otherwise(0))))
    words = F.split(blank_text("_row.text"), rf"(?<={WORD[:-1]})(?={BLANK})")
    cut = F.col("_part") > copies
    rows = rows.withColumn("_text", F.when(cut, F.array_join(F.slice(words, 1, rest.cast("int")), "")).otherwise(F.col("_row.text")))
    out = []
    for f in docs.schema.fields:
        value = F.col(f"_row.`{f.name}`")
        if f.name == "text":
            value = F.col("_text")
        elif f.name == "n_chars":
            value = F.when(cut, F.char_length("_text").cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return rows.select(*out)
