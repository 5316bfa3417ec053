"""Linear support vector machines that take their steps together: one pass over the rows serves all classes and all training sets.

MLlib fits one machine at a time, with a Spark job per step, so folds times classes times iterations of jobs. The machines here have the objective of
``LinearSVC`` without standardization (mean weighted hinge loss, ridge on the coefficients, free offset) and take L-BFGS steps on features of unit
deviation. A pass gives one row of sums per task; the driver holds the coefficients and their last steps.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.session import ship

#: Margins that a task holds at a time.
CELLS = 2_000_000
MEMORY, HALVINGS, TOLERANCE = 10, 6, 1e-6


def sums_of(batches, width: int, at: np.ndarray, sides: np.ndarray, left_out: np.ndarray, owner: np.ndarray):
    """One row with hinge loss and gradient, ``(machines, width + 2)``, over all rows of a task."""
    out = np.zeros((len(at), width + 2))
    step = max(1, CELLS // len(at))
    for b in batches:
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), width)
        y, w, fold = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "fold"))
        for i in range(0, len(x), step):
            part = x[i:i + step]
            own = y[i:i + step, None] == owner[None]
            sign = np.where(own, 1.0, -1.0)
            z = 1.0 - sign * (part @ at[:, :width].T + at[:, width])
            weight = w[i:i + step, None] * np.where(own, sides[:, 0], sides[:, 1]) * (fold[i:i + step, None] != left_out) * (z > 0)
            pull = -weight * sign
            out[:, :width] += pull.T @ part
            out[:, width] += pull.sum(0)
            out[:, width + 1] += (weight * z).sum(0)
    yield pa.RecordBatch.from_pydict({"sums": pa.array([out.tobytes()], pa.binary())})


def direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The L-BFGS direction from the last steps and what they changed in the gradient."""
    q, kept = -gradient, []
    for s, d in reversed(steps):
        a = (s @ q) / (s @ d)
        q = q - a * d
        kept.append(a)
    if steps:
        s, d = steps[-1]
        q = q * ((s @ d) / (d @ d))
    for (s, d), a in zip(steps, reversed(kept)):
        q = q + s * (a - (d @ q) / (s @ d))
    return q


def fit_together(rows: DataFrame, classes: int, left_out: Sequence[int], ridge: Sequence[float], max_iter: int, balanced: bool) -> np.ndarray:
    """Coefficients and offset, ``(sets, classes, width + 1)``, of one machine per class and training set.

    ``rows(x array, y int, w double, fold int)`` is read once per step. A set has the rows of all folds but ``left_out``'s (-1: of all folds) and its ``ridge``.
    ``balanced`` lets both sides of each machine weigh the same.
    """
    ship(rows.sparkSession)
    width = rows.agg(F.max(F.size("x"))).first()[0]
    spread = {r["i"]: r["s"] for r in rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.stddev_pop("v").alias("s")).collect()}
    factor = np.array([1.0 / spread[i] if spread[i] > 0 else 0.0 for i in range(width)])
    sums = {(r["fold"], r["y"]): r["w"] for r in rows.groupBy("fold", "y").agg(F.sum("w").alias("w")).collect()}
    owner, sets = np.tile(np.arange(classes), len(left_out)), np.repeat(np.arange(len(left_out)), classes)
    outside = np.array(left_out)[sets]
    mine = np.array([sum(w for (f, y), w in sums.items() if f != o and y == k) for o, k in zip(outside, owner)])
    whole = np.array([sum(w for (f, _), w in sums.items() if f != o) for o in outside])
    two = (mine > 0) & (mine < whole) & balanced
    with np.errstate(divide="ignore", invalid="ignore"):
        sides = np.where(two[:, None], np.stack([whole / (2 * mine), whole / (2 * (whole - mine))], 1), 1.0)
    total = mine * sides[:, 0] + (whole - mine) * sides[:, 1]
    total = np.where(total > 0, total, 1.0)
    penalty = np.asarray(ridge, float)[sets, None] * factor ** 2

    def look(at: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss and gradient of some of the machines."""
        given = (np.hstack([at[:, :width] * factor, at[:, width:]]), sides[some], outside[some], owner[some])
        found = rows.mapInArrow(lambda batches: sums_of(batches, width, *given), "sums binary").collect()
        # sorted, as the sums of doubles depend on their order
        s = sum(np.frombuffer(x, float) for x in sorted(bytes(r["sums"]) for r in found)).reshape(len(some), width + 2) / total[some, None]
        gradient = s[:, :width + 1].copy()
        gradient[:, :width] = gradient[:, :width] * factor + penalty[some] * at[:, :width]
        return s[:, width + 1] + 0.5 * (penalty[some] * at[:, :width] ** 2).sum(1), gradient

    n = len(owner)
    at, steps, left = np.zeros((n, width + 1)), [[] for _ in range(n)], np.full(n, max_iter)
    loss, gradient = look(at, np.arange(n))
    way, size, halvings = -gradient, 1.0 / np.maximum(1.0, np.linalg.norm(gradient, axis=1)), np.zeros(n, int)
    todo = np.flatnonzero((left > 0) & (np.abs(gradient).max(1) > 0))
    while len(todo):
        trial = at[todo] + size[todo, None] * way[todo]
        losses, gradients = look(trial, todo)
        for k, m in enumerate(todo):
            slope = gradient[m] @ way[m]
            if losses[k] > loss[m] + 1e-4 * size[m] * slope:
                size[m], halvings[m] = size[m] / 4, halvings[m] + 1
                if halvings[m] > HALVINGS:
                    left[m] = 0 if not steps[m] else left[m]
                    # a kink: once more from here, straight down
                    steps[m], way[m], size[m], halvings[m] = [], -gradient[m], 1.0 / max(1.0, np.linalg.norm(gradient[m])), 0
                continue
            s, d = trial[k] - at[m], gradients[k] - gradient[m]
            if s @ d > 1e-10 * (d @ d):
                steps[m] = [*steps[m], (s, d)][-MEMORY:]
            left[m] = 0 if loss[m] - losses[k] <= TOLERANCE * max(abs(losses[k]), 1e-12) else left[m] - 1
            at[m], loss[m], gradient[m] = trial[k], losses[k], gradients[k]
            way[m], size[m], halvings[m] = direction(gradient[m], steps[m]), 1.0, 0
            if gradient[m] @ way[m] >= 0:
                steps[m], way[m] = [], -gradient[m]
        todo = todo[left[todo] > 0]
    at[:, :width] *= factor
    return at.reshape(len(left_out), classes, width + 1)
