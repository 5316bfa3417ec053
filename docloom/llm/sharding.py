"""Sharding (operator 5).

Method: balanced label propagation. Every document starts in a shard chosen by a hash. In each round a Spark aggregate
counts, per group of linked documents, its members in each shard; a join moves members towards the shard where most of
their neighbours are, as far as the shard has room or gives up as many in the same round. Rounds go on until the documents outside
their unit's shard no longer fall. What is linked are documents of equal text; a cut edge is a pair of neighbours
in different shards. Groups of more than ``1 / UNITS_PER_SHARD`` of a shard are cut into units by a hash of ``doc_id``,
so that no group exceeds a shard or a task; the units of one group start towards common shards.

Law ``rows``: shards hold equal numbers of rows, at most one apart. After the last round each shard lists its linked documents
first and the others after them; whatever stands beyond the shard's share moves to the shards that are short, in order. So
unlinked documents give way, and the law holds exactly whatever the rounds did. Positions are counted in slices of a hash,
never over a whole shard in one task.

Native: DataFrame functions only; texts are read once and never shuffled. Only totals per shard reach the driver.

Defined cases: null text has size 8, CRC-32 0 and is equal to empty text for the groups; a null ``doc_id`` is a
value like any other; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from docloom.llm.common import blank_text, dense_positions, guarded, settle

SHARDS = 24
#: Propagation has converged after so many rounds in a row without a fall.
PATIENCE = 2
UNITS_PER_SHARD = 8
SLICE_ROWS = 2_000


def facts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: ``rid``, ``doc_id``, ``size``, ``text_crc32`` and its text's digest, settled."""
    raw = F.encode(blank_text(text), "utf-8")
    return settle(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(blank_text(text)) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("sha")), "shard-facts")


def linked_units(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """Rows of texts that occur more than once: ``rid, unit, seed, split``: the shard the unit leans to, and whether its group has other units."""
    most = max(1, total // (shards * UNITS_PER_SHARD))
    groups = settle(rows.groupBy("sha").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "shard-groups")
    parts = F.ceil(F.col("copies") / most).cast("long")
    part = F.pmod(F.xxhash64("rid", F.lit(3)), parts)
    lean = F.pmod(F.xxhash64("sha") + F.floor(part / UNITS_PER_SHARD), F.lit(shards)).cast("int")
    return rows.join(groups, "sha").select("rid", F.xxhash64("sha", part).alias("unit"), lean.alias("seed"), (parts > 1).alias("split"))


def admitted(room: list[int], flows: dict[tuple[int, int], int]) -> list[float]:
    """Per shard, the largest share of its wishes that can be let in at once: inflow is at most room plus the outflow let in elsewhere.

    ``flows`` has the rows that wish from one shard into another. All shares begin at 1 and fall until none takes in too much.
    """
    asked = [sum(n for (_, to), n in flows.items() if to == s) for s in range(len(room))]
    share = [1.0] * len(room)
    while True:
        out = [sum(n * share[to] for (at, to), n in flows.items() if at == s) for s in range(len(room))]
        lower = [min(x, max(0.0, (room[s] + out[s]) / asked[s])) if asked[s] else x for s, x in enumerate(share)]
        if all(x - y < 1e-4 for x, y in zip(share, lower)):
            return lower
        share = lower


def propagate(members: DataFrame, shards: int, quotas: list[int]) -> DataFrame:
    """Moves members (``rid, unit, seed, split, shard``) towards their neighbours' shards until it converges; returns the same columns.

    A unit that is in several shards wishes for the one with most of its members; ties go to the shard it leans to, then to a hash of the round. In
    the first round, units of a group with several wish for where they lean, as neighbours lean there too. From the second on, chance weighs more
    with every round, and a shard drawn by hash is a choice as well, so that who was turned away tries elsewhere. A full shard takes in as much as
    leaves it in the same round (``admitted``). A hash of unit and round lets in the share that fits, whole units at a time.
    """
    turn, least, still = 0, None, 0
    unit = Window.partitionBy("unit")
    while still < PATIENCE:
        load = {r["shard"]: r["n"] for r in members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = [quotas[s] - load.get(s, 0) for s in range(shards)]
        cells = members.groupBy("unit", "seed", "split", "shard").agg(F.count(F.lit(1)).alias("n"))
        if turn == 0:  # a unit may gather where it leans to even if none of it is there yet
            extra, score = F.col("seed"), F.when(F.col("split") & (F.col("shard") == F.col("seed")), F.lit(float(1 << 60))).otherwise(F.col("n").cast("double"))
        else:
            extra = F.pmod(F.xxhash64("unit", F.lit(turn), F.lit(7)), F.lit(shards)).cast("int")
            score = F.col("n") + turn * F.pmod(F.xxhash64("unit", "shard", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        more = cells.select("unit", "seed", "split", extra.alias("shard")).distinct().withColumn("n", F.lit(0).cast("long"))
        cells = cells.unionByName(more).groupBy("unit", "seed", "split", "shard").agg(F.sum("n").alias("n"))
        cells = cells.withColumn("away", F.sum("n").over(unit) - F.max("n").over(unit))
        if turn:
            cells = cells.where("away > 0")
        likes = F.struct(score.alias("score"), (F.col("shard") == F.col("seed")).cast("int").alias("lean"),
                         F.xxhash64("unit", "shard", F.lit(turn)).alias("draw"), F.col("shard").alias("to"))
        wishes = settle(cells.withColumn("wish", F.max(likes).over(unit)["to"]).where("n > 0").select("unit", "shard", "wish", "n", "away"), f"shard-wishes-{turn}")
        flows = {(r["shard"], r["wish"]): r["n"] for r in wishes.where("shard <> wish").groupBy("shard", "wish").agg(F.sum("n").alias("n")).collect()}
        cut = wishes.groupBy("unit").agg(F.max("away").alias("away")).agg(F.sum("away")).first()[0] or 0
        still = 0 if least is None or cut < least else still + 1
        least = cut if least is None else min(cut, least)
        if not flows or still == PATIENCE:
            break
        share = admitted(room, flows)
        let_in = F.pmod(F.xxhash64("unit", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30) < F.element_at(F.array(*[F.lit(x) for x in share]), F.col("wish") + 1)
        chosen = wishes.where(let_in).where("shard <> wish").select("unit", "shard", "wish")
        members = settle(members.join(chosen, ["unit", "shard"], "left").withColumn("shard", F.coalesce("wish", "shard")).drop("wish"), f"shard-round-{turn}")
        turn += 1
    return members


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; ``linked`` tells whether its text has copies."""
    rows = facts(docs)
    total = rows.count()
    share = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(shards)).cast("int")
    members = settle(linked_units(rows, shards, total).withColumn("shard", start), "shard-members")
    moved = propagate(members, shards, share).select("rid", F.col("shard").alias("_moved"), "unit")
    placed = rows.join(moved, "rid", "left").select(
        "rid", "doc_id", "size", "text_crc32", F.coalesce("_moved", start).alias("shard"), F.col("unit").isNotNull().alias("linked"),
        F.coalesce("unit", F.xxhash64("rid", F.lit(2))).alias("_mix"))
    # linked documents fill the lower half of the slices, units side by side
    half = max(1, total // (2 * shards * SLICE_ROWS))
    slice_no = F.pmod(F.xxhash64("_mix", F.lit(5)), F.lit(half)) + F.when(F.col("linked"), 0).otherwise(half)
    placed = settle(dense_positions(placed.withColumn("_slice", slice_no), ["shard"], ["_mix", "rid"], "_at", 2 * half), "shard-placed")

    load = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    over, short, given, taken = [], [], 0, 0
    for s in range(shards):
        n = load.get(s, 0)
        over.append(given - share[s])  # number of a surplus row: its position plus this
        given += max(0, n - share[s])
        if n < share[s]:
            short.append((taken, share[s] - n, s, n))
            taken += share[s] - n
    pick = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)
    number = F.col("_at") + pick(over)
    shard, slot = F.col("shard"), F.col("_at")
    for first, many, s, n in short:
        here = (F.col("_at") >= pick(share)) & (number >= first) & (number < first + many)
        shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, number - first + n).otherwise(slot)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "linked")
