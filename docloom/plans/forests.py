"""Forests of deep trees that are as large as their data: grown, kept, saved and read as tables.

MLlib holds all nodes on the driver and sends a histogram per node and task however few rows a node has. Here a node with more than ``LOCAL_ROWS`` rows is
split by one histogram per task over all rows, and its few numbers are all that the driver holds. Smaller nodes are parts: their rows, as bins of a byte,
are shuffled to them once, and each subtree grows in a task. A part's tree stays a row of a table. For scoring, rows are shuffled to their parts, and
their leaves' class shares, which are whole numbers, are summed per row. Everything grows with rows times trees.

Features have up to 32 bins with quantiles of all rows as edges, in place of MLlib's midpoints of a sample. Nodes split by Gini impurity until they are pure,
gain nothing, or reach the deepest level. Samples are Poisson draws by the row's id, or its position where there is no id column. Vectors must not be NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.scale import write_side
from docloom.plans import growing
from docloom.plans.growing import BINS
from docloom.plans.nested import NestedModel, NestedReader, NestedWriter, with_prediction
from docloom.session import ship

#: Rows drawn for a node, from which on it is split over all tasks.
LOCAL_ROWS = 50_000
#: Numbers in the histograms of one pass over the rows, 128 MB a task.
PASS_CELLS = 16 << 20
#: Tasks that parts are dealt to, at most.
MOST_TASKS = 4000
PART = "part long, tree int, size long, feature binary, cut binary, left binary, shares binary, importance array<double>"

#: P(X <= k) of a Poisson draw is added up to this many copies of a row.
MOST_COPIES = 12


def bootstrap_count(id: Column, tree: int | Column, rate: float, seed: int) -> Column:
    """How often a row is in the sample of a tree: a Poisson draw of mean ``rate`` from the hash of row, tree and seed."""
    u = F.pmod(F.xxhash64(id, F.lit(tree), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    p = below = math.exp(-rate)
    count = F.lit(0)
    for k in range(1, MOST_COPIES + 1):
        count = count + (u >= below).cast("int")
        p *= rate / k
        below += p
    return count


@dataclass
class Top:
    """The nodes of a tree above its parts. ``left`` of a node without feature is the position of its end."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    ends: list[dict] = field(default_factory=list)
    gains: list[tuple[int, float]] = field(default_factory=list)

    def arrays(self):
        return np.array(self.feature, np.int32), np.array(self.cut, np.uint8), np.array(self.left, np.int32)

    def add(self, depth: int) -> int:
        self.feature.append(-1)
        self.cut.append(0)
        self.left.append(0)
        self.depth.append(depth)
        return len(self.feature) - 1

    def end(self, node: int, size: float, totals: Sequence[float] | None = None) -> None:
        """A leaf if its class weights are given, else a part."""
        self.left[node] = len(self.ends)
        leaf = None if totals is None else growing.shares(np.array([totals], float))[0].tolist()
        self.ends.append({"depth": self.depth[node], "size": int(size), "leaf": leaf})


def part_id(tree: int, end: int) -> int:
    return (tree << 32) + end


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Rows dealt by their part to so many tasks that parts of one task are few; adaptive execution would put small ones together, however long they take."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, min(parts, MOST_TASKS)), *keys)


@dataclass(frozen=True)
class Forest:
    """What to fit. ``per_node`` features are drawn for each node (None: the root of their number, 0: all); ``allowed`` restricts them per tree."""

    trees: int = 100
    max_depth: int = 30
    min_leaf: int = 1
    rate: float = 1.0
    seed: int = 42
    weight: str | None = None
    per_node: int | None = 0
    allowed: Sequence[Sequence[int]] | None = None
    featuresCol: str = "features"
    labelCol: str = "label"
    id: str = "doc_id"

    def fit(self, train: DataFrame, kind: type[ForestModel] | None = None) -> ForestModel:
        ship(train.sparkSession)
        rows = self._rows(train)
        facts = rows.agg(F.count("*").alias("n"), F.max("y").alias("y"), F.max(F.size("x")).alias("width"), F.min(F.size("x")).alias("low")).first()
        if not facts["n"]:
            raise ValueError("no rows to fit a forest on")
        if facts["low"] != facts["width"] or facts["width"] < 1:
            raise ValueError("vectors of one width are needed")
        n, classes, width = facts["n"], facts["y"] + 1, facts["width"]
        edges = quantile_edges(rows, width)
        binned = write_side(rows.mapInArrow(_binner(edges), "row long, y int, w double, draws array<int>, bins binary"))
        allowed = [np.array(a) for a in self.allowed] if self.allowed else [np.arange(width)] * self.trees
        per_node = max(1, math.ceil(math.sqrt(width))) if self.per_node is None else self.per_node or width
        tops = self._tops(binned, n, classes, width, allowed, per_node)
        parts = self._parts(binned, tops, classes, width, allowed, per_node)
        state = {"classes": classes, "rows": n, "features": self.featuresCol, "edges": [e.tolist() for e in edges],
                 "tops": [{"feature": t.feature, "cut": t.cut, "left": t.left, "sizes": [e["size"] for e in t.ends], "gains": t.gains} for t in tops]}
        return (kind or ForestModel)(state, parts)

    def _rows(self, train: DataFrame) -> DataFrame:
        row = F.monotonically_increasing_id()
        id = F.col(self.id) if self.id in train.columns else F.col("row")
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        known = train.withColumn("row", row)
        draws = F.transform(F.sequence(F.lit(0), F.lit(self.trees - 1)), lambda t: bootstrap_count(id, t, self.rate, self.seed))
        return write_side(known.select("row", F.col(self.labelCol).cast("int").alias("y"), weight.alias("w"), draws.alias("draws"),
                                       vector_to_array(self.featuresCol).alias("x")))

    def _tops(self, binned: DataFrame, n: int, classes: int, width: int, allowed: list[np.ndarray], per_node: int) -> list[Top]:
        """Split what is too large for a task, level by level; all nodes of a level share their passes."""
        tops = [Top() for _ in range(self.trees)]
        if n * self.rate <= LOCAL_ROWS or self.max_depth < 1:
            for t in tops:
                t.end(0, n * self.rate)
            return tops
        at_once = max(1, PASS_CELLS // (min(per_node, width) * BINS * (classes + 1)))
        todo = [(t, 0) for t in range(self.trees)]
        while todo:
            later: list[tuple[int, int]] = []
            for i in range(0, len(todo), at_once):
                for r in self._best(binned, tops, todo[i:i + at_once], classes, width, allowed, per_node).collect():
                    later += self._apply(tops[r["tree"]], r)
            todo = later
        return tops

    def _apply(self, top: Top, r) -> list[tuple[int, int]]:
        node = r["node"]
        if r["feature"] < 0:
            top.end(node, r["low_rows"] + r["high_rows"], [a + b for a, b in zip(r["low"], r["high"])])
            return []
        depth = top.depth[node] + 1
        top.feature[node], top.cut[node] = r["feature"], r["cut"]
        top.left[node] = top.add(depth)
        top.add(depth)
        top.gains.append((r["feature"], r["gain"]))
        large = []
        for child, totals, size in ((top.left[node], r["low"], r["low_rows"]), (top.left[node] + 1, r["high"], r["high_rows"])):
            if depth >= self.max_depth or size < 2 * self.min_leaf or sum(x > 0 for x in totals) < 2:
                top.end(child, size, totals)
            elif size > LOCAL_ROWS:
                large.append((r["tree"], child))
            else:
                top.end(child, size)
        return large

    def _best(self, binned: DataFrame, tops: list[Top], todo: list[tuple[int, int]], classes: int, width: int, allowed: list[np.ndarray],
              per_node: int) -> DataFrame:
        """Best split of each node of ``todo``; one histogram per node and task is shuffled."""
        seed, min_leaf = self.seed, self.min_leaf
        # the position of a node, not of its end, is what an open node leads to
        arrays = {t: (*tops[t].arrays()[:2], np.where(np.array(tops[t].feature) < 0, np.arange(len(tops[t].feature)), tops[t].left)) for t, _ in todo}
        drawn = {(t, k): growing.draw_features(np.random.default_rng([seed, t, k]), 1, allowed[t], per_node)[0] for t, k in todo}

        def count(batches):
            held: dict[tuple[int, int], list[np.ndarray]] = {}
            for b in batches:
                bins, y, w, draws = _columns(b, width)
                for t, arrays_t in arrays.items():
                    seen = np.flatnonzero(draws[:, t])
                    at = growing.leaf_of(bins[seen], *arrays_t)
                    for k in np.unique(at):
                        if (t, int(k)) not in drawn:
                            continue
                        r = seen[at == k]
                        c = draws[r, t]
                        for slot, f in enumerate(drawn[t, int(k)]):
                            found = growing.histogram(bins[r, f].astype(np.int64), np.zeros(len(r), np.int64), y[r], w[r] * c, c, 1, classes)
                            whole = held.setdefault((t, int(k)), [np.zeros((len(drawn[t, int(k)]), BINS, classes)), np.zeros((len(drawn[t, int(k)]), BINS))])
                            whole[0][slot] += found[0][0]
                            whole[1][slot] += found[1][0]
            for (t, k), (weights, counts) in held.items():
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "node": pa.array([k], pa.int32()),
                                                  "weights": pa.array([weights.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

        def choose(key, table):
            t, k = (x.as_py() for x in key)
            # sorted, as the sums of doubles depend on their order
            weights = sum(np.frombuffer(x, float) for x in sorted(table["weights"].to_pylist())).reshape(-1, BINS, classes)
            counts = sum(np.frombuffer(x, float) for x in table["counts"].to_pylist()).reshape(-1, BINS)
            gain, cut = growing.best_bins(weights, counts, min_leaf)
            s = int(gain.argmax())
            upto = int(cut[s]) + 1
            low, high = weights[s, :upto].sum(0), weights[s, upto:].sum(0)
            return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([k], pa.int32()),
                             "feature": pa.array([int(drawn[t, k][s]) if gain[s] > 0 else -1], pa.int32()), "cut": pa.array([int(cut[s])], pa.int32()),
                             "gain": [float(gain[s] * weights[s].sum())], "low": [low.tolist()], "high": [high.tolist()],
                             "low_rows": [float(counts[s, :upto].sum())], "high_rows": [float(counts[s, upto:].sum())]})

        found = binned.mapInArrow(count, "tree int, node int, weights binary, counts binary")
        return spread(found, len(todo), "tree", "node").groupBy("tree", "node").applyInArrow(
            choose, "tree int, node int, feature int, cut int, gain double, low array<double>, high array<double>, low_rows double, high_rows double")

    def _parts(self, binned: DataFrame, tops: list[Top], classes: int, width: int, allowed: list[np.ndarray], per_node: int) -> DataFrame:
        """The subtrees, one row each; ends that are leaves are trees of one node."""
        max_depth, min_leaf, seed = self.max_depth, self.min_leaf, self.seed
        arrays, ends = [t.arrays() for t in tops], [[(e["depth"], e["size"], e["leaf"] is None) for e in t.ends] for t in tops]

        def deal(batches):
            for b in batches:
                bins, y, w, draws = _columns(b, width)
                ids = b.column("row").to_numpy(zero_copy_only=False)
                for t, top in enumerate(arrays):
                    seen = np.flatnonzero(draws[:, t])
                    at = growing.leaf_of(bins[seen], *top)
                    seen, at = (x[np.array([e[2] for e in ends[t]])[at]] for x in (seen, at))
                    if len(seen):
                        yield pa.RecordBatch.from_pydict({"part": part_id(t, 0) + at.astype(np.int64), "row": ids[seen], "y": y[seen].astype(np.int32), "w": w[seen],
                                                          "n": draws[seen, t].astype(np.int32), "bins": growing.from_bytes(bins[seen])})

        def subtree(key, table):
            part = key[0].as_py()
            t, end = part >> 32, part & 0xFFFFFFFF
            table = table.sort_by("row")
            depth, size, _ = ends[t][end]
            y, w, n = (table[c].to_numpy() for c in ("y", "w", "n"))
            grown = growing.grow(growing.as_bytes(table["bins"], width), y.astype(np.int64), w * n, n.astype(float), classes, allowed[t], per_node, min_leaf,
                                 max_depth - depth, np.random.default_rng([seed, t, 1 << 20, end]))
            feature, cut, left, shares, importance = grown
            return pa.table({"part": [part], "tree": pa.array([t], pa.int32()), "size": [size], "feature": [feature.tobytes()], "cut": [cut.tobytes()],
                             "left": [left.tobytes()], "shares": [shares.tobytes()], "importance": [importance.tolist()]})

        dealt = binned.mapInArrow(deal, "part long, row long, y int, w double, n int, bins binary")
        grown = spread(dealt, sum(e[2] for x in ends for e in x), "part").groupBy("part").applyInArrow(subtree, PART)
        one = (np.array([-1], np.int32).tobytes(), np.zeros(1, np.uint8).tobytes(), np.zeros(1, np.int32).tobytes())
        leaves = [(part_id(t, k), t, e["size"], *one, np.array(e["leaf"], np.int64).tobytes(), [0.0] * width)
                  for t, top in enumerate(tops) for k, e in enumerate(top.ends) if e["leaf"] is not None]
        # a tree whose sample is empty has no rows to grow from
        empty = [(part_id(t, 0), t, 0, *one, growing.shares(np.zeros((1, classes))).tobytes(), [0.0] * width) for t in range(self.trees)]
        fixed = binned.sparkSession.createDataFrame(leaves, PART) if leaves else None
        parts = write_side(grown.unionByName(fixed) if fixed is not None else grown)
        if parts.count() < sum(len(t.ends) for t in tops):
            known = parts.select("part")
            parts = write_side(parts.unionByName(binned.sparkSession.createDataFrame(empty, PART).join(known, "part", "left_anti").select(*parts.columns)))
        return parts


def _columns(batch: pa.RecordBatch, width: int):
    draws = batch.column("draws")
    return (growing.as_bytes(batch.column("bins"), width), batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64),
            batch.column("w").to_numpy(zero_copy_only=False), draws.flatten().to_numpy(zero_copy_only=False).reshape(len(draws), -1).astype(np.int64))


def _values(column, width: int) -> np.ndarray:
    if column.null_count:
        raise ValueError("vectors must not be NULL")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _binner(edges: list[np.ndarray]):
    def run(batches):
        for b in batches:
            bins = growing.to_bins(_values(b.column("x"), len(edges)), edges)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("row", "y", "w", "draws")], growing.from_bytes(bins)], ["row", "y", "w", "draws", "bins"])
    return run


def quantile_edges(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, per position of the array ``x``."""
    at = [k / BINS for k in range(1, BINS)]
    found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.percentile_approx("v", at, 10000).alias("q")).collect()
    edges = {r["i"]: np.unique(np.array(r["q"], float)) for r in found}
    return [edges[i] for i in range(width)]


class ForestModel(NestedModel):
    """A fitted forest: a table of subtrees, and on the driver the few nodes above them. The probability is the mean over the trees."""

    def __init__(self, state: dict | None = None, parts: DataFrame | None = None):
        super().__init__()
        self._state, self.parts = state or {}, parts

    def inner(self):
        return {}

    def state(self):
        return self._state

    @classmethod
    def restored(cls, state, inner):
        return cls(state, inner["parts"])

    def write(self):
        return ForestWriter(self)

    @classmethod
    def read(cls):
        return ForestReader(cls)

    @property
    def numClasses(self) -> int:
        return self._state["classes"]

    @property
    def trees(self) -> list[SimpleNamespace]:
        """The importances of each tree, adding up to 1."""
        width = len(self._state["edges"])
        sums = np.zeros((len(self._state["tops"]), width))
        cells = self.parts.select("tree", F.posexplode("importance").alias("i", "v")).groupBy("tree", "i").agg(F.sum("v").alias("v")).where("v > 0")
        for r in cells.collect():
            sums[r["tree"], r["i"]] += r["v"]
        for t, top in enumerate(self._state["tops"]):
            for f, gain in top["gains"]:
                sums[t, f] += gain
        whole = sums.sum(1, keepdims=True)
        return [SimpleNamespace(featureImportances=DenseVector(x)) for x in sums / np.where(whole > 0, whole, 1.0)]

    @property
    def featureImportances(self) -> DenseVector:
        summed = sum(t.featureImportances.toArray() for t in self.trees)
        return DenseVector(summed / (summed.sum() or 1.0))

    def _transform(self, df: DataFrame) -> DataFrame:
        """Rows are written with a position of their own, meet their parts in one shuffle per (row, tree), and get their sums back in another."""
        ship(df.sparkSession)
        state, features = self._state, self._state["features"]
        classes, edges = state["classes"], [np.array(e) for e in state["edges"]]
        tops = [(np.array(t["feature"], np.int32), np.array(t["cut"], np.uint8), np.array(t["left"], np.int32)) for t in state["tops"]]
        rows = write_side(df.withColumn("_row", F.monotonically_increasing_id()))
        scale = max(1.0, rows.count() / state["rows"])
        # a part gets a task per LOCAL_ROWS rows that it may have to score
        slices = [np.array([max(1, math.ceil(size * scale / LOCAL_ROWS)) for size in t["sizes"]], np.int64) for t in state["tops"]]
        of_part = {part_id(t, k): int(s) for t, x in enumerate(slices) for k, s in enumerate(x) if s > 1}

        def deal(batches):
            for b in batches:
                bins = growing.to_bins(_values(b.column("x"), len(edges)), edges)
                ids = b.column("_row").to_numpy(zero_copy_only=False)
                packed = growing.from_bytes(bins)
                for t, top in enumerate(tops):
                    at = growing.leaf_of(bins, *top)
                    yield pa.RecordBatch.from_pydict({"part": part_id(t, 0) + at.astype(np.int64), "slice": ids % slices[t][at], "_row": ids, "bins": packed})

        def score(key, mine, parts):
            part = parts.slice(0, 1).to_pylist()[0]
            tree = (np.frombuffer(part["feature"], np.int32), np.frombuffer(part["cut"], np.uint8), np.frombuffer(part["left"], np.int32))
            leaf = growing.leaf_of(growing.as_bytes(mine["bins"], len(edges)), *tree)
            shares = np.frombuffer(part["shares"], np.int64).reshape(-1, classes)[leaf]
            return pa.table({"_row": mine["_row"], **{f"s{c}": np.ascontiguousarray(shares[:, c]) for c in range(classes)}})

        dealt = rows.select("_row", vector_to_array(features).alias("x")).mapInArrow(deal, "part long, slice long, _row long, bins binary")
        copies = F.lit(1)
        if of_part:
            many = df.sparkSession.createDataFrame(list(of_part.items()), "part long, slices int")
            sides = self.parts.join(F.broadcast(many), "part", "left")
            copies = F.coalesce("slices", F.lit(1))
        else:
            sides = self.parts
        sides = sides.select("part", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)).alias("slice"), "feature", "cut", "left", "shares")
        groups = sum(int(x.sum()) for x in slices)
        met = spread(dealt, groups, "part", "slice").groupBy("part", "slice").cogroup(spread(sides, groups, "part", "slice").groupBy("part", "slice"))
        sums = met.applyInArrow(score, f"_row long, {', '.join(f's{c} long' for c in range(classes))}").groupBy("_row").agg(
            *[F.sum(f"s{c}").alias(f"s{c}") for c in range(classes)])
        whole = sum((F.col(f"s{c}") for c in range(1, classes)), F.col("s0"))
        found = sums.select("_row", F.array(*[F.col(f"s{c}") / whole for c in range(classes)]).alias("_p"))
        return with_prediction(rows.join(found, "_row"), df.columns)


class ForestWriter(NestedWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.parts.write.parquet(f"{path}/parts")


class ForestReader(NestedReader):
    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind.restored(metadata["state"], {"parts": self.sparkSession.read.schema(PART).parquet(f"{path}/parts")})
        model._resetUid(metadata["uid"])
        return model
