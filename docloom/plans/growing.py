"""Array helpers of ``forests``, run inside tasks: histograms, best splits, growing a subtree, finding leaves."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

#: Bins of a feature, as in MLlib.
BINS = 32
#: A split has to lower the impurity by more than the noise of sums.
MIN_GAIN = 1e-12
#: Leaf shares are whole multiples of 1 / SHARE, so that their sums are the same in every order.
SHARE = 1 << 40
#: Histogram cells that are held at a time.
CELLS = 2_000_000


def as_bytes(column, width: int) -> np.ndarray:
    """A binary column of ``width`` bytes a row as matrix."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(a):
        return np.zeros((0, width), np.uint8)
    offsets = np.frombuffer(a.buffers()[1], np.int32)
    first = int(offsets[a.offset])
    return np.frombuffer(a.buffers()[2], np.uint8)[first:first + len(a) * width].reshape(len(a), width)


def from_bytes(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = (np.arange(rows + 1, dtype=np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def to_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of edges below it, so that ``bin <= b`` is ``value <= edges[b]``."""
    return np.stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def histogram(bins: np.ndarray, node: np.ndarray, y: np.ndarray, w: np.ndarray, n: np.ndarray, nodes: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights per (node, bin, class) and rows drawn per (node, bin) of one feature."""
    key = node * BINS + bins
    return (np.bincount(key * classes + y, w, nodes * BINS * classes).reshape(nodes, BINS, classes),
            np.bincount(key, n, nodes * BINS).reshape(nodes, BINS))


def best_bins(weights: np.ndarray, counts: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Gain in Gini impurity of the best bin per node, and the bin; no gain where none leaves ``min_leaf`` rows on both sides."""
    left = weights.cumsum(1)
    total = left[:, -1]
    below, whole = left.sum(2), total.sum(1)
    squares = np.einsum("nc,nc->n", total, total)
    low = np.einsum("nbc,nbc->nb", left, left)
    high = squares[:, None] - 2 * np.einsum("nbc,nc->nb", left, total) + low
    rows = counts.cumsum(1)
    allowed = (rows >= min_leaf) & (rows[:, -1:] - rows >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(allowed, low / below + high / (whole[:, None] - below), -np.inf)
        cut = np.where(np.isnan(score), -np.inf, score).argmax(1)
        gain = score[np.arange(len(cut)), cut] / whole - squares / whole ** 2
    return np.where(gain > MIN_GAIN, gain, 0.0), cut


def draw_features(draw: np.random.Generator, nodes: int, allowed: np.ndarray, per_node: int) -> np.ndarray:
    """The features that each node may split on, ``(nodes, per_node)``."""
    if per_node >= len(allowed):
        return np.broadcast_to(allowed, (nodes, len(allowed)))
    return allowed[np.argpartition(draw.random((nodes, len(allowed))), per_node - 1, axis=1)[:, :per_node]]


def shares(totals: np.ndarray) -> np.ndarray:
    """Class weights of leaves as whole shares; equal ones where there is no weight."""
    whole = totals.sum(1, keepdims=True)
    p = np.where(whole > 0, totals / np.where(whole > 0, whole, 1.0), 1.0 / totals.shape[1])
    return np.rint(p * SHARE).astype(np.int64)


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, n: np.ndarray, classes: int, allowed: np.ndarray, per_node: int, min_leaf: int, levels: int,
         draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A subtree of at most ``levels`` splits in depth, all nodes of a level at once.

    Gives per node its feature (-1: a leaf), its bin, and the position of its left child (the right one follows; of a leaf: of its
    shares), the shares of the leaves, and the importance per feature.
    """
    rows, node, m, first = np.arange(len(y)), np.zeros(len(y), np.int64), 1, 0
    found, leaves, leaf_count, importance = [], [], 0, np.zeros(bins.shape[1])
    for level in range(levels + 1):
        totals = np.bincount(node * classes + y[rows], w[rows], m * classes).reshape(m, classes)
        drawn = np.bincount(node, n[rows], m)
        feature, cut, gain = np.full(m, -1, np.int32), np.zeros(m, np.uint8), np.zeros(m)
        ids = np.flatnonzero(((totals > 0).sum(1) > 1) & (drawn >= 2 * min_leaf)) if level < levels else np.zeros(0, np.int64)
        chosen = draw_features(draw, len(ids), allowed, per_node)
        spot = np.full(m, -1)
        spot[ids] = np.arange(len(ids))
        mine = spot[node] >= 0
        r, at = rows[mine], spot[node[mine]]
        size = max(1, CELLS // (BINS * classes))
        for low in range(0, len(ids), size):
            some = min(size, len(ids) - low)
            a, b = np.searchsorted(at, [low, low + some])
            part, own = r[a:b], at[a:b] - low
            yy, ww, nn = y[part], w[part], n[part]
            where = ids[low:low + some]
            for slot in range(chosen.shape[1]):
                f = chosen[low:low + some, slot]
                g, c = best_bins(*histogram(bins[part, f[own]].astype(np.int64), own, yy, ww, nn, some, classes), min_leaf)
                better = g > gain[where]
                gain[where[better]], cut[where[better]], feature[where[better]] = g[better], c[better], f[better]
        split = feature >= 0
        np.add.at(importance, feature[split], gain[split] * totals[split].sum(1))
        child = np.zeros(m, np.int64)
        child[split] = 2 * np.arange(split.sum())
        left = np.where(split, first + m + child, leaf_count + np.cumsum(~split) - 1).astype(np.int32)
        found.append((feature, cut, left))
        leaves.append(shares(totals[~split]))
        leaf_count += len(leaves[-1])
        on = split[node]
        rows, node = rows[on], node[on]
        node = child[node] + (bins[rows, feature[node]] > cut[node])
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        first, m = first + m, 2 * int(split.sum())
        if not m:
            break
    feature, cut, left = (np.concatenate(x) for x in zip(*found))
    return feature, cut, left, np.concatenate(leaves), importance


def leaf_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """What ``left`` says of the leaf that each row ends in."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        a = at[rows]
        at[rows] = left[a] + (bins[rows, feature[a]] > cut[a])
    return left[at]
