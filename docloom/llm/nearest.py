"""Exact top-k search by inner product (operator 12).

Method: Voronoi kNN join. Vectors become integers, and every row goes to its nearest of ``PIVOTS`` pivots, rows of the table drawn by hash. A
summary per cell, the ``k + 1`` smallest distances to the pivot, gives each query a score that at least ``k`` other rows reach: a row at distance ``d``
of pivot ``p`` scores ``q.p - |q| d`` at least and ``q.p + |q| d`` at most. So a block of queries, which is a group of cells of queries, needs of a
cell only the rows at a distance of at least ``min((bound - q.p) / |q|)`` over its queries. Only these rows are sent to the
block, in chunks sorted by cell and distance, and the block is solved there on all chunks, one after the other. Results of a
block's parts are merged per query. The result is exact whatever the pivots are; they decide only how much is sent.

A task holds one block of queries (``BLOCK`` at most) with ``k`` results each and streams the data, so memory does not grow with
the table. Cells of queries above ``BLOCK``, such as copies of one vector, are split; small cells share a block. A chunk of data is
sent once per block that needs it.

Defined cases: null vectors, vectors with null or non-finite entries and vectors of another length than most take no part; entries count
as 2**50 at most, scaled, and scores beyond 64 bits as the largest; rows without ``vec_id`` are candidates, last on ties, and no
queries; of rows with equal ``vec_id`` each is a query and a candidate of the others; ties go to the smaller ``vec_id``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docloom.llm.common import guarded, settle
from docloom.llm.vectors import common_length, integer_rows

SCALE, EVERY, TOP = 64, 20, 20
PIVOTS = 64
#: Rows of a chunk, rows sorted together before they are cut into chunks, queries of a block, tasks per block at most.
CHUNK, SORTED, BLOCK, PARTS = 2048, 1 << 16, 1 << 18, 16
#: Rows of the table per task of a block at least.
PART_ROWS = 4096
#: Scores computed at a time.
SCORES = 1 << 22
#: Distances are doubles: bounds give way by this share.
SLACK = 1e-9
SIGN = np.uint64(1 << 63)
NO_ID = np.uint64((1 << 64) - 1)
PACKED = "query boolean, cell int, far double, nearest array<double>, n int, width int, keys binary, rows binary, data binary"


def draw_pivots(vectors: DataFrame, length: int, scale: int, wanted: int = PIVOTS) -> np.ndarray:
    """At most ``wanted`` different rows with the smallest hashes, as integers: a fixed number of rows on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _ = integer_rows(batch.column(2), length, scale)
            yield batch.take(pa.array(at))

    usable = vectors.mapInArrow(run, vectors.schema).select("vector", F.xxhash64("row", "vector").alias("h"))
    drawn = usable.orderBy("h").limit(wanted).select("vector").toArrow().column(0).combine_chunks()
    _, x = integer_rows(drawn, length, scale)
    return np.unique(x, axis=0).astype(np.float64)


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def packed(vectors: DataFrame, pivots: np.ndarray, length: int, scale: int, every: int, k: int) -> DataFrame:
    """All usable rows, and once more the queries among them, in chunks of one cell sorted by distance to its pivot; settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at, x = integer_rows(batch.column(2), length, scale)
            ids = batch.column(1).take(pa.array(at))
            none = ids.is_null().to_numpy(zero_copy_only=False)
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            held.append((x, np.where(none, NO_ID, numbers.astype(np.int64).view(np.uint64) ^ SIGN), batch.column(0).to_numpy()[at], ~none & (numbers % every == 0)))
            n += len(at)
            if n >= SORTED:
                yield from chunks(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield from chunks(*map(np.concatenate, zip(*held)))

    def chunks(x: np.ndarray, keys: np.ndarray, rows: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        y = x.astype(np.float64)
        squares = np.maximum((y ** 2).sum(axis=1)[:, None] - 2 * y @ pivots.T + (pivots ** 2).sum(axis=1), 0)
        cells = squares.argmin(axis=1)
        away = np.sqrt(squares[np.arange(len(y)), cells])
        for query in (False, True):
            some = np.flatnonzero(asks) if query else np.arange(len(x))
            some = some[np.lexsort((away[some], cells[some]))]
            own, starts = np.unique(cells[some], return_index=True)
            cuts = [(c, s) for c, a, b in zip(own, starts, [*starts[1:], len(some)]) for s in (some[i:min(i + CHUNK, b)] for i in range(a, b, CHUNK))]
            columns = [(query, int(c), float(away[s].max()), away[s][:k + 1].tolist(), len(s), (z := narrow(x[s])).itemsize, keys[s].tobytes(), rows[s].tobytes(), z.tobytes()) for c, s in cuts]
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*columns), KINDS)], names=NAMES)

    return settle(vectors.mapInArrow(run, PACKED), "packed-vectors")


NAMES = [c.split()[0] for c in PACKED.split(", ")]
KINDS = [pa.bool_(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def unpacked(batch: pa.RecordBatch, row: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, row numbers and integers of a chunk."""
    get = lambda name: batch.column(name)[row].as_py()
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[get("width")]
    return np.frombuffer(get("keys"), np.uint64), np.frombuffer(get("rows"), np.int64), np.frombuffer(get("data"), kind).reshape(-1, length)


def query_blocks(chunks: DataFrame, pivots: np.ndarray, block: int) -> dict[int, tuple[int, int]]:
    """Cell -> (first block, number of blocks). Cells next to each other share a block while their queries fit; large ones get several."""
    sizes = {r["cell"]: r["n"] for r in chunks.where("query").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    order, left = [], set(sizes)
    while left:  # a walk from pivot to nearest pivot
        here = min(left) if not order else min(left, key=lambda c: (((pivots[c] - pivots[order[-1]]) ** 2).sum(), c))
        order.append(here)
        left.remove(here)
    out, at, held = {}, 0, 0
    for c in order:
        parts = -(-sizes[c] // block)
        if held and (parts > 1 or held + sizes[c] > block):
            at, held = at + 1, 0
        out[c] = (at, parts)
        at, held = (at + parts, 0) if parts > 1 else (at, held + sizes[c])
    return out


def reaches(queries: DataFrame, nearest: list[list[float]], pivots: np.ndarray, length: int, k: int) -> DataFrame:
    """``block, cell, reach``: a block needs of a cell the rows at a distance of ``reach`` at least. From the summaries ``nearest`` of all cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                q = unpacked(batch, row, length)[2].astype(np.float64)
                size = np.sqrt((q ** 2).sum(axis=1))[:, None]
                to = q @ pivots.T
                sure = np.concatenate([to[:, [c]] - size * np.array(d) for c, d in enumerate(nearest) if d], axis=1)
                bound = np.sort(sure, axis=1)[:, -(k + 1)][:, None] if sure.shape[1] > k else np.full((len(q), 1), -np.inf)
                give = SLACK * (1 + np.abs(bound) + np.abs(to) + size)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(size > 0, (bound - to - give) / size, np.where(bound - give > 0, np.inf, -np.inf))
                b = batch.column("block")[row].as_py()
                least[b] = np.minimum(least.get(b, np.inf), need.min(axis=0))
        rows = [(b, c, float(r)) for b, need in least.items() for c, r in enumerate(need)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [()] * 3, (pa.int32(), pa.int32(), pa.float64()))], names=["block", "cell", "reach"])

    found = queries.mapInArrow(run, "block int, cell int, reach double")
    return settle(found.groupBy("block", "cell").agg(F.min("reach").alias("reach")), "reaches")


class Best:
    """The ``k`` best rows of each query of a block, so far."""

    def __init__(self, k: int):
        self.k = k
        self.q_keys, self.q_rows, self.q = [], [], []
        self.ready = False

    def add_queries(self, keys: np.ndarray, rows: np.ndarray, x: np.ndarray) -> None:
        self.q_keys.append(keys)
        self.q_rows.append(rows)
        self.q.append(x)

    def settle(self) -> None:
        self.q_keys, self.q_rows, self.q = (np.concatenate(a) for a in (self.q_keys, self.q_rows, self.q))
        order = np.argsort(self.q_rows)
        self.q_keys, self.q_rows, self.q = self.q_keys[order], self.q_rows[order], self.q[order]
        n = len(self.q)
        self.scores, self.keys, self.held = np.zeros((n, self.k), np.int64), np.zeros((n, self.k), np.uint64), np.zeros(n, np.int64)
        self.most = int(np.abs(self.q.astype(np.int64)).max())
        self.ready = True

    def add(self, keys: np.ndarray, rows: np.ndarray, x: np.ndarray) -> None:
        if not self.ready:
            self.settle()
        bound = self.most * int(np.abs(x.astype(np.int64)).max()) * x.shape[1]
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
        data, step = x.astype(kind).T, max(1, SCORES // len(x))
        for a in range(0, len(self.q), step):
            self.merge(a, self.q[a:a + step].astype(kind) @ data, keys, rows)

    def merge(self, a: int, scores: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        n, m = scores.shape
        if scores.dtype == object:
            scores = np.clip(scores, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)
        own = slice(a, a + n)
        q_rows, held = self.q_rows[own], self.held[own]
        at = np.searchsorted(q_rows, rows)
        self_at = np.flatnonzero((at < n) & (q_rows[np.minimum(at, n - 1)] == rows))
        full = held == self.k
        hit = (scores >= self.scores[own, -1][:, None]) | ~full[:, None]
        hit[at[self_at], self_at] = False
        if m > 4 * self.k and hit.sum() > 4 * self.k * n:  # the k-th best here bounds what can stay; one more for the row itself
            hit &= scores >= np.partition(scores, m - self.k - 1, axis=1)[:, m - self.k - 1][:, None]
        query, row = np.nonzero(hit)
        if not len(query):
            return
        old = np.arange(self.k) < held[:, None]
        who = np.concatenate([np.nonzero(old)[0], query])
        score = np.concatenate([self.scores[own][old], scores[query, row].astype(np.int64)])
        key = np.concatenate([self.keys[own][old], keys[row]])
        order = np.lexsort((key, -score, who))
        who, score, key = who[order], score[order], key[order]
        starts = np.searchsorted(who, np.arange(n))
        rank = np.arange(len(who)) - starts[who]
        stay = rank < self.k
        self.scores[a + who[stay], rank[stay]], self.keys[a + who[stay], rank[stay]] = score[stay], key[stay]
        self.held[own] = np.bincount(who[stay], minlength=n)

    def results(self) -> Iterator[pa.RecordBatch]:
        if not self.ready:
            return
        for a in range(0, len(self.q), 4096):
            own = slice(a, a + 4096)
            there = np.arange(self.k) < self.held[own][:, None]
            who = np.nonzero(there)[0]
            key = self.keys[own][there]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.q_rows[own][who]), pa.array((self.q_keys[own][who] ^ SIGN).view(np.int64)),
                 pa.array((key ^ SIGN).view(np.int64), mask=key == NO_ID), pa.array(self.scores[own][there])],
                names=["row", "query_id", "vec_id", "score"])


def top_neighbours(df: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE, vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest inner product for each row whose ``vec_id`` is divisible by ``every``."""
    spark = df.sparkSession
    given = settle(df.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector")), "vectors")
    length = common_length(given, "vector")
    pivots = draw_pivots(given, length, scale) if length else np.empty((0, 0))
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chunks = packed(given, pivots, length, scale, every, k)

    distances = chunks.where("NOT query").select("cell", F.explode("nearest").alias("d"))
    ranked = distances.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("d"))).where(F.col("r") <= k + 1)
    nearest: list[list[float]] = [[] for _ in pivots]
    for r in ranked.collect():  # k + 1 numbers per pivot
        nearest[r["cell"]].append(r["d"])
    place = query_blocks(chunks, pivots, block)
    if not place:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = max(first + n for first, n in place.values())
    rows = chunks.where("NOT query").agg(F.sum("n")).collect()[0][0]
    parts = max(1, min(PARTS, rows // PART_ROWS))

    first = F.element_at(F.create_map(*[F.lit(x) for c, (b, _) in place.items() for x in (c, b)]), F.col("cell"))
    several = F.element_at(F.create_map(*[F.lit(x) for c, (_, n) in place.items() for x in (c, n)]), F.col("cell"))
    queries = chunks.where("query").withColumn("block", (first + F.pmod(F.xxhash64("rows"), several).cast("int")).cast("int"))
    reach = guarded(reaches(queries, nearest, pivots, length, k))
    wanted = chunks.where("NOT query").join(reach, "cell").where("far >= reach")
    sent = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(*NAMES, "block", "part").unionByName(
        wanted.withColumn("part", F.pmod(F.xxhash64("rows"), F.lit(parts)).cast("int")).select(*NAMES, "block", "part"))
    task = (F.col("block") * parts + F.col("part")).alias("task")
    dealt = sent.select(*NAMES, task).repartitionById(blocks * parts, "task").sortWithinPartitions("task", F.desc("query"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = None, Best(k)
        for batch in batches:
            for row in range(batch.num_rows):
                task = batch.column("task")[row].as_py()
                if task != at:
                    yield from best.results()
                    at, best = task, Best(k)
                (best.add_queries if batch.column("query")[row].as_py() else best.add)(*unpacked(batch, row, length))
        yield from best.results()

    found = settle(dealt.mapInArrow(solve, "row long, query_id long, vec_id long, score long"), "block-results")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
