"""Embedding whitening (operator 11).

Method: FEAST contour integration. Spark passes over the vectors give exact integer sums, first of the vectors, then of the products of
vectors centred at the rounded mean; so the covariance is exact up to one rounding, however the rows are spread. Of that matrix, one row and
column per dimension, the driver finds the leading eigenvectors: inertia counts (Sylvester's law, from a pivoted symmetric
factorization) place eigenvalue intervals that hold the wanted ones; for each interval, a quadrature over a circle around it, one solve
with a complex shifted covariance per node, projects a block of vectors onto the interval's eigenvectors; Rayleigh-Ritz extracts them. An interval is done
when its residuals are at the level of rounding and as many eigenvalues are found as the inertia counts say; until then the block is filtered again,
and made larger. The last pass over the vectors projects them, in tasks.

Defined cases: null vectors, vectors with null or non-finite entries and vectors of another length than most take no part; entries count as
2**50 at most, scaled; rows without ``vec_id``, with equal ones or with equal vectors are rows like others; directions without
variance are no components, so one vector, or copies of one, give no rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import settle
from docloom.llm.vectors import common_length, integer_rows

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
NODES = 16
#: Eigenvalues in an interval at most, unless they cannot be told apart.
PER_INTERVAL = 4
#: A share of the largest eigenvalue that counts as none, and the residual that is accepted.
NO_VARIANCE, RESIDUAL = 1e-12, 2e-14
WHOLE = pa.decimal128(38, 0)


def _whole(numbers) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in numbers], WHOLE)


def sums(vectors: DataFrame, length: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of usable vectors and exact sum per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            _, x = integer_rows(batch.column(0), length, scale, shift)
            n += len(x)
            high, low = x >> 25, x & ((1 << 25) - 1)
            total += high.sum(axis=0).astype(object) * (1 << 25) + low.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), _whole(total)], names=["i", "n", "s"])

    parts = vectors.mapInArrow(run, "i int, n long, s decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def covariance(vectors: DataFrame, length: int, scale: int, shift: int, n: int, total: list[int]) -> np.ndarray:
    """The covariance with divisor ``n``, from exact sums of products of centred vectors."""
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    upper = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = np.zeros((length, length), np.int64), 0
        for batch in batches:
            _, x = integer_rows(batch.column(0), length, scale, shift)
            if not len(x):
                continue
            y = x - centre
            most = int(np.abs(y).max()) ** 2 * len(y)
            if most >= 1 << 53:  # beyond exact doubles: whole numbers of any size
                wide = y.astype(object)
                yield cells(wide.T @ wide)
                continue
            if bound + most >= 1 << 62:
                yield cells(held)
                held, bound = np.zeros((length, length), np.int64), 0
            z = y.astype(np.float64)
            held += (z.T @ z).astype(np.int64)
            bound += most
        yield cells(held)

    def cells(products: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), _whole(products[upper])], names=["i", "j", "g"])

    parts = vectors.mapInArrow(run, "i int, j int, g decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("g").cast("decimal(38,0)").alias("g")).collect()
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    out = np.zeros((length, length))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = (n * int(r["g"]) - rest[r["i"]] * rest[r["j"]]) / (n * n)
    return out


def inertia(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix: blocks of order 1 and 2 are eliminated, the largest pivots first."""
    a, positive = a.copy(), 0
    while len(a):
        own = np.abs(np.diagonal(a))
        p = int(own.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        r, s = divmod(int(off.argmax()), len(a))
        if own[p] == 0 and off[r, s] == 0:
            break
        block = [p] if own[p] >= 0.64 * off[r, s] else [r, s]  # a block of order 2 has one eigenvalue of each sign
        rest = np.setdiff1d(np.arange(len(a)), block)
        positive += 1 if len(block) == 2 else int(a[p, p] > 0)
        side = a[np.ix_(rest, block)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(block, block)], side.T)
        a = (a + a.T) / 2
    return positive


def intervals(v: np.ndarray, wanted: int) -> tuple[list[tuple[float, float, int]], float]:
    """Intervals ``(low, high, eigenvalues inside)`` that hold the ``wanted`` largest eigenvalues above zero, and a bound of all of them."""
    size = len(v)
    bound = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    counts: dict[float, int] = {}

    def above(x: float) -> int:
        if x not in counts:
            counts[x] = inertia(v - x * np.eye(size))
        return counts[x]

    low, high = NO_VARIANCE * bound, bound
    wanted = min(wanted, above(low))
    for _ in range(60):
        if above(low) <= wanted or high - low <= 1e-9 * bound:
            break
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) >= wanted else (low, middle)
    out, open_ = [], [(low, bound)] if wanted else []
    while open_:
        a, b = open_.pop()
        inside = above(a) - above(b)
        if inside:
            middle = (a + b) / 2
            one_side = above(middle) in (above(a), above(b))
            if inside > PER_INTERVAL and b - a > 1e-9 * bound or one_side and b - a > 1e-3 * b:
                open_ += [(a, middle), (middle, b)]
            else:
                out.append((a, b, inside))
    return out, bound


def filtered(v: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """``block`` projected on the eigenvectors of the interval: a trapezoidal sum over the upper half of a circle, whose lower half is conjugate."""
    centre, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(block)
    for k in range(NODES):
        step = radius * np.exp(1j * np.pi * (k + 0.5) / NODES)
        total += (step / NODES * np.linalg.solve((centre + step) * np.eye(len(v)) - v, block)).real
    return total


def interval_vectors(v: np.ndarray, low: float, high: float, inside: int, bound: float) -> np.ndarray:
    """Orthonormal eigenvectors of the ``inside`` eigenvalues between ``low`` and ``high``, none missing."""
    draw = np.random.default_rng(7)
    width = min(len(v), 2 * inside + 6)
    block = draw.standard_normal((len(v), width))
    exact, done = RESIDUAL * bound * len(v) ** 0.5, False
    for turn in range(200):
        block, _ = np.linalg.qr(filtered(v, block, low, high))
        values, inner = np.linalg.eigh(block.T @ v @ block)
        found = block @ inner
        apart = np.abs(values - (low + high) / 2) - (high - low) / 2
        order = np.argsort(apart)
        own, others = order[:inside], order[inside:]
        residual = np.linalg.norm(v @ found[:, own] - found[:, own] * values[own], axis=0)
        if apart[own].max() <= exact and (apart[others] >= -exact).all() and residual.max() <= exact:
            if done:
                return found[:, own]
            done = True  # once more: what is left is at the level of rounding
        block = found
        if turn % 10 == 9 and width < len(v):  # slow: more room for eigenvalues next to the interval
            more = min(len(v), 2 * width) - width
            block, width = np.hstack([found, draw.standard_normal((len(v), more))]), width + more
    raise ArithmeticError(f"eigenvalues between {low} and {high}: not the {inside} that the inertia says")


def leading_components(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above zero, falling, and their unit eigenvectors as columns, largest entry positive."""
    parts, bound = intervals(v, components)
    if not parts:
        return np.empty(0), np.empty((len(v), 0))
    basis, _ = np.linalg.qr(np.hstack([interval_vectors(v, a, b, k, bound) for a, b, k in parts]))
    values, inner = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values, kind="stable")[:components]
    found = basis @ inner[:, order]
    found /= np.linalg.norm(found, axis=0)
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return values[order], found * signs


def square_sums(d: np.ndarray) -> pa.Array:
    """Exact sum of squares per row."""
    if len(d) == 0 or float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0 ** 62:
        return pa.array((d * d).sum(axis=1), pa.int64()).cast(WHOLE)
    return _whole((row.astype(object) ** 2).sum() for row in d)


def projected(vectors: DataFrame, length: int, scale: int, shift: int, n: int, total: list[int], values: np.ndarray, axes: np.ndarray) -> DataFrame:
    """``vec_id, deviation, whitened`` (array) per usable row."""
    weights = axes / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(total, object)
        for batch in batches:
            at, x = integer_rows(batch.column(1), length, scale, shift)
            safe = len(x) == 0 or n * int(np.abs(x).max()) + max(map(abs, total)) < 1 << 62
            d = x * n - sums.astype(np.int64) if safe else x.astype(object) * n - sums
            centred = d.astype(np.float64) / n if safe else (d / n).astype(np.float64)
            white = centred @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), square_sums(d) if safe else _whole((d * d).sum(axis=1)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))],
                names=["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, vector: str = "embedding") -> DataFrame:
    """Per usable row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is a decimal, since its size grows with the square of the number of rows.
    """
    given = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    only = given.select("vector")
    length = common_length(given, "vector")
    n, total = sums(only, length, scale, shift) if length else (0, [])
    values, axes = np.empty(0), np.empty((length, 0))
    if n:
        v = covariance(only, length, scale, shift, n, total)
        values, axes = leading_components(v, components)
    kept = len(values)
    if not kept:
        return df.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    rows = settle(projected(given, length, scale, shift, n, total, values, axes), "whitened")
    white = F.col("whitened")
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    apart = rows.agg(F.greatest(F.lit(0.0), F.lit(0.0), *[F.abs(F.covar_pop(white[i], white[j]) - F.lit(float(i == j))) for i, j in pairs]).alias("e")).collect()[0]["e"]
    explained = F.array(*[F.lit(float(x / np.trace(v))) for x in values])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(float(apart)).alias("identity_error"))
