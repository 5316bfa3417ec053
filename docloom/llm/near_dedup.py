"""MinHash near-dedup (operator 10).

Method: tensored banding. Two collections of ``GROUPS`` groups of ``ROWS`` minhashes are computed per document; every pair of
one group from each makes the key of a table, so ``GROUPS ** 2`` tables of ``2 * ROWS`` minhashes need only ``2 * GROUPS * ROWS`` minhash
computations, about the square root. A table key is formed only where both halves are shared with another document: a table can have
no candidates elsewhere. At a similarity of 0.8 a pair is missed with a probability of 7e-6 by the default sizes, at 0.85 of 2e-8.

Documents with equal shingle sets are one node from the start. Candidates are checked in rounds of stars: each bucket that holds more than one
component has a head, its member with the smallest hash of the round, and a node is compared with the ``HEADS`` smallest heads of its buckets that are not
in its component. The buckets are the tables in the first round, and the halves of their keys after that, which are fewer. A round so costs ``HEADS`` pairs
a node at most, and few heads serve many nodes: a large group of near copies, of which not all are similar to each other, becomes one component
in ``ROUNDS`` rounds, without its pairs. What is then left of a table's pairs between components is tried in
full, so no link that the tables offer is lost: nodes with one half of a key in common meet in blocks of ``BLOCK`` rows, those outside of the half's largest
component against all, and a pair is tried where its first common half is, if it also has a common half in the other collection. Two exact bounds go before any comparison of sets: the sizes,
and the parity sketch of ``SKETCH`` bits, whose Hamming distance never exceeds the symmetric difference. All links are confirmed on the full
sets of 64-bit shingle hashes.

Defined cases: null text, or text without words, has no shingles and is linked with nothing; texts shorter than a shingle are
one shingle; rows with the same ``doc_id`` are one document; rows without ``doc_id`` come last as smallest document and cannot be told apart; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docloom.llm.common import guarded, settle
from docloom.llm.components import connected

GROUPS, ROWS = 24, 4
SKETCH = 2048
PERCENT = 80
ROUNDS, HEADS = 3, 8
BLOCK = 1024
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * M1
    h = (h ^ (h >> np.uint64(33))) * M2
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Distinct shingle hashes, minhash keys, parity sketch and fingerprint of a text."""

    def __init__(self, words: int, groups: int = GROUPS, rows: int = ROWS):
        draw = np.random.default_rng(20_240_601)
        n = 2 * groups * rows
        self.words, self.groups, self.rows = words, groups, rows
        self.times = draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.flips = draw.integers(0, 2**63, n, dtype=np.uint64)
        self.weights = draw.integers(0, 2**63, max(words, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.slots = mixed(np.arange(1, 2 * groups + 1, dtype=np.uint64))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes."""
        # bytes: lower() changes A-Z only, split() cuts at exactly [\x20\x09-\x0D]
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not found:
            return np.empty(0, np.uint64)
        if len(found) < self.words:
            return np.array([xxhash.xxh64_intdigest(b" ".join(found), 11)], np.uint64)
        h = mixed(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)))
        n = len(h) - self.words + 1
        total = np.zeros(n, np.uint64)
        for k in range(self.words):
            total += h[k:k + n] * self.weights[k]
        return np.unique(mixed(total))

    def keys(self, h: np.ndarray) -> np.ndarray:
        """One key per group: the first half are the one collection, the second half the other."""
        least = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(h), 1024):
            np.minimum(least, ((h[at:at + 1024, None] ^ self.flips) * self.times).min(axis=0), out=least)
        groups = (mixed(least).reshape(2 * self.groups, self.rows) * self.weights[:self.rows]).sum(axis=1, dtype=np.uint64)
        return mixed(groups ^ self.slots)

    @staticmethod
    def parity(h: np.ndarray) -> np.ndarray:
        odd = np.bincount((h >> np.uint64(17)).astype(np.int64) & (SKETCH - 1), minlength=SKETCH).astype(np.uint8) & 1
        return np.packbits(odd).view(np.uint64)

    @staticmethod
    def fingerprint(h: np.ndarray) -> bytes:
        return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _long_lists(rows: list[np.ndarray | None]) -> pa.Array:
    return pa.array([None if r is None else r.view(np.int64) for r in rows], pa.list_(pa.int64()))


def signatures(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """Per row: ``rid, doc_id, n_shingles, fp, keys, sketch``, settled; the last three are null without shingles."""
    given = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingler.shingles(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(h) for h in sets], pa.int64()),
                     pa.array([shingler.fingerprint(h) if len(h) else None for h in sets], pa.binary()),
                     _long_lists([shingler.keys(h) if len(h) else None for h in sets]),
                     _long_lists([shingler.parity(h) if len(h) else None for h in sets])],
                    names=["rid", "doc_id", "n_shingles", "fp", "keys", "sketch"])

    return settle(given.mapInArrow(run, "rid long, doc_id long, n_shingles long, fp binary, keys array<long>, sketch array<long>"), "signatures")


def shingle_sets(docs: DataFrame, words: int, wanted: DataFrame, text: str = "text") -> DataFrame:
    """``node, hashes`` (binary) for the nodes of ``wanted`` (``node, fp``), from the texts once more; settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = [shingler.shingles(t) for t in batch.slice(at, 500).column(0).to_pylist()]
                sets = [h for h in sets if len(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shingler.fingerprint(h) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())],
                    names=["fp", "hashes"])

    sets = docs.select(text).mapInArrow(run, "fp binary, hashes binary")
    return settle(sets.join(guarded(wanted), "fp").dropDuplicates(["node"]).select("node", "hashes"), "shingle-sets")


def first_document() -> Column:
    """Orders documents by ``doc_id``, null last, then row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("row"))


def could_link(n: str, m: str, s: str, t: str, percent: int) -> Column:
    """Exact bounds: false only if the sets of sizes ``n, m`` and parity sketches ``s, t`` are less than ``percent`` similar."""
    sizes = (100 * F.least(n, m) >= percent * F.greatest(n, m))
    apart = sum((F.bit_count(F.col(s)[k].bitwiseXOR(F.col(t)[k])) for k in range(SKETCH // 64)), F.lit(0))
    # 100 * common >= p * union  <=>  difference * (100 + p) <= (100 - p) * (n + m)
    return sizes & (apart * (100 + percent) <= (100 - percent) * (F.col(n) + F.col(m)))


def fitting(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``u, v`` and more) that pass the exact bounds."""
    left = facts.select(F.col("node").alias("u"), F.col("n_shingles").alias("nu"), F.col("sketch").alias("su"))
    right = facts.select(F.col("node").alias("v"), F.col("n_shingles").alias("nv"), F.col("sketch").alias("sv"))
    return pairs.join(left, "u").join(right, "v").where(could_link("nu", "nv", "su", "sv", percent)).select(*pairs.columns)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """The labels ``lu, lv`` of the ``pairs`` (``u, v, lu, lv``) whose full sets are at least ``percent`` similar, settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["lu", "lv"])

    with_u = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u")
    both = with_u.join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    return settle(both.select("lu", "lv", "hu", "hv").mapInArrow(run, "lu long, lv long"), name)


def stars(state: DataFrame, turn: int) -> DataFrame:
    """At most ``HEADS`` pairs ``u, v, lu, lv`` per node of ``state`` (``bucket, node, label``): the node and heads of its buckets with other labels."""
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("v"), F.col("label").alias("lv"))
    heads = state.groupBy("bucket").agg(F.min(rank).alias("head"))
    met = state.join(heads, "bucket").where("label <> head.lv").groupBy("node", "label").agg(F.collect_set("head").alias("heads"))  # one per table at most
    return met.select(F.col("node").alias("u"), F.col("label").alias("lu"), F.inline(F.slice(F.array_sort("heads"), 1, HEADS))).select("u", "v", "lu", "lv")


def relabelled(df: DataFrame, moves: DataFrame, name: str) -> DataFrame:
    """``df`` with its ``label`` after ``moves`` (``node, label``: old and new label), settled."""
    to = guarded(moves.select(F.col("node").alias("label"), F.col("label").alias("_to")))
    return settle(df.join(to, "label", "left").withColumn("label", F.coalesce("_to", "label")).select(*df.columns), name)


def mixed_buckets(state: DataFrame, name: str) -> DataFrame:
    """The rows of buckets with more than one label, settled."""
    several = state.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("bucket")
    return settle(state.join(several, "bucket", "left_semi"), name)


def pairs_left(nodes: DataFrame, percent: int, groups: int = GROUPS) -> DataFrame:
    """``u, v, lu, lv``: all pairs of ``nodes`` (``node, label, n_shingles, keys, sketch``) with a common table, different labels and sketches that fit; settled.

    A group is at most ``BLOCK`` rows outside of a half's largest component and ``BLOCK`` of all its rows, whatever the half holds.
    """
    wide = nodes.select("node", "label", "n_shingles", "keys", "sketch", F.posexplode(F.slice("keys", 1, groups)).alias("slot", "half"))
    sizes = wide.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n"))
    main = (sizes.groupBy("half").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all")).where(F.col("all") > F.col("m.n"))
            .select("half", F.col("m.label").alias("main"), F.ceil((F.col("all") - F.col("m.n")) / BLOCK).cast("int").alias("lefts"),
                    F.ceil(F.col("all") / BLOCK).cast("int").alias("rights")))
    active = settle(wide.join(main, "half").withColumn("outside", F.col("label") != F.col("main")), "active")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["half", "slot", "node", "label", "n_shingles", "keys", "sketch", "outside"]
    left = active.where("outside").select(*columns, F.lit(True).alias("left"), block("lefts").alias("lb"), every("rights").alias("rb"))
    right = active.select(*columns, F.lit(False).alias("left"), block("rights").alias("rb"), every("lefts").alias("lb"))

    def fit(table: pa.Table) -> pa.Table:
        mine = table.column("left").to_numpy(zero_copy_only=False)
        flat = lambda name, width: table.column(name).combine_chunks().flatten().to_numpy().reshape(-1, width)
        slot = table.column("slot")[0].as_py()
        node, label, n, out = (table.column(c).to_numpy() for c in ("node", "label", "n_shingles", "outside"))
        keys, sketch = flat("keys", 2 * groups), flat("sketch", SKETCH // 64).view(np.uint64)
        a, b = np.flatnonzero(mine), np.flatnonzero(~mine)
        least, most = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
        u, v = np.nonzero((label[a][:, None] != label[b]) & (~out[b] | (node[a][:, None] < node[b])) & (100 * least >= percent * most))
        u, v = a[u], b[v]
        for k in range(slot):  # a pair is tried at its first common half
            apart = keys[u, k] != keys[v, k]
            u, v = u[apart], v[apart]
        common = np.zeros(len(u), bool)
        for k in range(groups, 2 * groups):
            common |= keys[u, k] == keys[v, k]
        u, v = u[common], v[common]
        found = []
        for at in range(0, len(u), 1 << 16):
            x, y = u[at:at + (1 << 16)], v[at:at + (1 << 16)]
            differ = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64)
            near = differ * (100 + percent) <= (100 - percent) * (n[x] + n[y])
            found.append((node[x[near]], node[y[near]], label[x[near]], label[y[near]]))
        columns = [np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found) if found else [()] * 4)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["u", "v", "lu", "lv"])

    return settle(left.unionByName(right).groupBy("half", "lb", "rb").applyInArrow(fit, "u long, v long, lu long, lv long"), "rest")


def candidate_tables(nodes: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Buckets of the tensored tables with two and more nodes: ``bucket, node``; of buckets with the same members one stays. Settled."""
    halves = nodes.select("node", F.posexplode("keys").alias("slot", "key"))
    shared = settle(halves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "half-keys")
    first = F.col("slot") < groups
    own = (halves.join(shared, "key").groupBy("node")
           .agg(F.collect_list(F.when(first, F.col("key"))).alias("a"), F.collect_list(F.when(~first, F.col("key"))).alias("b")))
    cells = settle(own.select("node", F.explode("a").alias("a"), "b").select("node", "a", F.explode("b").alias("b"))
                   .select("node", F.xxhash64("a", "b").alias("bucket")), "table-keys")
    members = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
                                          F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y")).where("n > 1")
    distinct = settle(members.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"), "tables")
    return settle(cells.join(distinct, "bucket").select("bucket", "node"), "table-members")


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, text: str = "text") -> DataFrame:
    """``node, label``: components of the nodes that have a confirmed link."""
    members = candidate_tables(nodes)
    facts = settle(nodes.join(members.select("node").distinct(), "node").select("node", "fp", "n_shingles", "sketch"), "candidates")
    sets = shingle_sets(docs, words, facts.select("node", "fp"), text)
    labels = settle(facts.select("node", F.col("node").alias("label")), "labels")
    state = members.withColumn("label", F.col("node"))  # every bucket has nodes of several labels
    for turn in range(ROUNDS):
        pairs = settle(fitting(stars(state, turn), facts, percent), f"stars-{turn}")
        linked = confirmed(pairs, sets, percent, f"star-links-{turn}")
        moves = connected(linked.select(F.col("lu").alias("u"), F.col("lv").alias("v")), f"near-{turn}")
        labels = relabelled(labels, moves, f"labels-{turn}")
        if turn == 0:
            state = nodes.select("node", F.explode("keys").alias("bucket")).join(guarded(labels), "node")
        else:
            state = relabelled(state, moves, f"state-{turn}")
        state = mixed_buckets(state, f"mixed-{turn}")

    open_ = settle(state.select("node", "label").distinct().join(nodes.select("node", "n_shingles", "keys", "sketch"), "node"), "open-nodes")
    linked = confirmed(pairs_left(open_, percent), sets, percent, "rest-links")
    return relabelled(labels, connected(linked.select(F.col("lu").alias("u"), F.col("lv").alias("v")), "near"), "labels")


def near_groups(docs: DataFrame, words: int = 4, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept`` and ``fp``."""
    rows = signatures(docs, words, text)
    sets = settle(rows.where("n_shingles > 0").groupBy("fp").agg(F.min(first_document()).alias("first")), "set-classes")
    nodes = rows.where("n_shingles > 0").join(sets.select(F.col("first.row").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    nodes = settle(nodes.select("node", "doc_id", "fp", "n_shingles", "keys", "sketch"), "nodes")
    labels = links(docs, nodes, words, percent, text)
    classes = sets.select("fp", "first", F.col("first.row").alias("node")).join(labels, "node", "left")
    classes = settle(classes.select("fp", "first", F.coalesce("label", "node").alias("group")), "near-groups")
    least = guarded(settle(classes.groupBy("group").agg(F.min("first").alias("best")).select("group", F.col("best.id").alias("best_id")), "near-least"))
    best = settle(classes.join(least, "group").select("fp", "best_id"), "near-classes")
    return rows.join(best, "fp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("best_id")).otherwise(F.col("doc_id")).alias("component_id"), "fp") \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest ``doc_id``; columns unchanged.

    The texts meet the table of dropped documents by set and ``doc_id``: by broadcast when that table is small, else in one shuffle.
    """
    lost = settle(near_groups(docs, words, percent, text).where("NOT kept").select(
        F.col("fp").alias("_lost_fp"), F.coalesce("doc_id", F.lit(0)).alias("_lost"), F.col("doc_id").isNull().alias("_none")).distinct(), "near-lost")
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sets = [shingler.shingles(t) for t in part.column(at).to_pylist()]
                prints = pa.array([shingler.fingerprint(h) if len(h) else None for h in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, prints], names=[*names, "_fp"])

    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_fp", T.BinaryType())]))
    same = ((F.col("_fp") == F.col("_lost_fp")) & (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)) == F.col("_lost"))
            & (F.col("doc_id").isNull() == F.col("_none")))
    return marked.join(guarded(lost), same, "left_anti").select(*[F.col(f"`{c}`") for c in names])
