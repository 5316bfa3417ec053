"""Whitening and exact search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import nearest, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
EXTRA = {c: 9 for c in ("row", "vector", "n", "cell", "block", "rank", "score", "component", "task")}


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def some(n, d, seed=1, spread=None):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, d)) * (spread if spread is not None else 0.3)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


AWKWARD = [(100, None), (101, [0.1, None, 0.2, 0.3]), (102, [0.1, math.nan, 0.2, 0.3]), (103, [math.inf, 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, []),
           (None, [0.5, 0.5, -0.5, 0.25]), (20, [0.25, 0.25, 0.25, 0.25]), (20, [0.25, 0.25, 0.25, 0.25]), (40, [0.0, 0.0, 0.0, 0.0]), (41, [0.25, 0.25, 0.25, 0.25])]


def usable(rows, d):
    return [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def whitened_by_hand(rows, d, k):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in usable(rows, d)], object)
    n = len(x)
    dev = n * x - x.sum(axis=0)
    y = (dev / n).astype(float)
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:k]
    return n, [int((r * r).sum()) for r in dev], y, values[order], axes[:, order], values.sum()


@pytest.mark.parametrize("rows,d", [(some(300, 12), 12), (some(60, 4) + AWKWARD, 4), (some(200, 10, spread=np.array([9, 9, 3, 3, 3, 1, 1, 1, .1, .1])), 10),
                                    (some(5, 12), 12), (some(40, 4) + [(200, [3e3, 0.0, 0.0, 0.0]), (201, [-2e4, 1.0, 0.0, 0.0])], 4)])
def test_whitening_as_by_hand(spark, rows, d):
    got = whitening.whiten(table(spark, rows).withColumns({c: F.lit(v) for c, v in EXTRA.items()}).repartition(3)).collect()
    n, deviations, y, values, axes, trace = whitened_by_hand(rows, d, 8)
    kept = int((values > 1e-11 * values[0]).sum())
    assert kept == min(8, d, n - 1)
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) <= 1e-6
    assert len(got) == n * kept and {r["component"] for r in got} == set(range(1, kept + 1))
    for k in range(kept):
        own = [r for r in got if r["component"] == k + 1]
        assert own[0]["explained"] == pytest.approx(values[k] / trace, rel=1e-6)
        wanted = y @ axes[:, k] / math.sqrt(values[k])
        pairs = lambda w: sorted((str(i), dv, round(x, 5) + 0.0) for (i, _), dv, x in zip(usable(rows, d), deviations, w))
        found = sorted((str(r["vec_id"]), int(r["deviation"]), round(r["whitened"], 5) + 0.0) for r in own)
        assert any(all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 for a, b in zip(found, pairs(s * wanted))) for s in (1, -1))


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 7)).count() == 0


@pytest.mark.parametrize("values", [[5.0, 5.0, 5.0, 1.0, 1.0, 0.5], [1e6, 3.0, 2.999, 2.998, 1e-3, 0.0], [7.0] * 6, [4.0, 3.0, 2.0, 1.0, 0.5, 0.25]])
def test_contours_find_every_eigenvalue(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    for k in (1, 3, 6):
        found, axes = whitening.leading_components(v, k)
        wanted = [x for x in sorted(values, reverse=True)[:k] if x > 0]
        assert np.allclose(found, wanted, rtol=1e-9, atol=1e-9 * values[0])
        assert np.allclose(axes.T @ axes, np.eye(len(wanted)), atol=1e-12) and np.abs(v @ axes - axes * found).max() <= 1e-12 * max(values)


def test_inertia_counts_signs():
    draw = np.random.default_rng(5)
    for n in (1, 2, 5, 17):
        a = draw.standard_normal((n, n))
        a = a + a.T
        assert whitening.inertia(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1 and whitening.inertia(np.zeros((3, 3))) == 0


def top_by_hand(rows, d, k, every, scale=64):
    good = [(i, [math.floor(scale * c) for c in v]) for i, v in usable(rows, d)]
    out = []
    for a, (i, q) in enumerate(good):
        if i is not None and i % every == 0:
            scored = sorted(((max(min(-sum(x * y for x, y in zip(q, v)), 2**63 - 1), 1 - 2**63), j is None, j or 0, j) for b, (j, v) in enumerate(good) if b != a))[:k]
            out += [(i, r + 1, j, max(min(-s, 2**63 - 1), 1 - 2**63)) for r, (s, _, _, j) in enumerate(scored)]
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows,d,k,block", [(some(400, 8), 8, 20, 7), (some(60, 4) + AWKWARD, 4, 5, 3), (some(12, 4), 4, 20, 100), (some(300, 4) + [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(1000, 1200)], 4, 6, 5),
                                            ([(i, [1.0 * (i % 3), 0.0]) for i in range(200)], 2, 4, 1000), (some(30, 4) + [(60, [2.0 ** 41, -1.0, 0.0, 0.0]), (61, [2.0 ** 31, 0.0, 1.0, 0.0])], 4, 3, 4)])
def test_top_neighbours_as_by_hand(spark, monkeypatch, rows, d, k, block):
    monkeypatch.setattr(nearest, "PART_ROWS", 50)
    df = table(spark, rows).withColumns({c: F.lit(v) for c, v in EXTRA.items()}).repartition(4)
    assert as_rows(nearest.top_neighbours(df, k=k, every=20, block=block)) == top_by_hand(rows, d, k, 20)


def test_only_needed_rows_are_sent(spark):
    """Short vectors around zero cannot be among the best of long queries."""
    draw = np.random.default_rng(2)
    far = [(i, [float(c) for c in 4 + draw.standard_normal(4) * 0.01]) for i in range(0, 400)]
    short = [(i, [float(c) for c in draw.standard_normal(4) * 0.01]) for i in range(1001, 3000, 2)]
    seen = []
    add = nearest.reaches

    def spy(*a):
        out = add(*a)
        seen.append(out)
        return out

    rows = far + short
    try:
        nearest.reaches = spy
        assert as_rows(nearest.top_neighbours(table(spark, rows), k=5)) == top_by_hand(rows, 4, 5, 20)
    finally:
        nearest.reaches = add
    assert seen[0].where("reach > 1").count() > 0


def test_top_neighbours_without_rows(spark):
    assert nearest.top_neighbours(table(spark, [])).count() == 0
    assert nearest.top_neighbours(table(spark, [(1, [1.0, 2.0]), (3, None)])).count() == 0
    assert as_rows(nearest.top_neighbours(table(spark, [(0, [1.0, 2.0])]))) == []
