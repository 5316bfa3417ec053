"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re

import pytest
from helpers import DOCS, awkward, clashing, components, empty, repeats_removed, shingles
from pyspark.sql import functions as F

from docloom.llm import dedup, near_dedup, substrings


def with_copies(spark, sf):
    """The small documents with near copies, a hot group and shared passages added."""
    draw = random.Random(3)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    longest = sorted(rows, key=lambda r: -len(r[1]))[:6]
    for k, (_, t) in enumerate(longest):
        for j in range(8):
            w = t.split(" ")
            for _ in range(1 + j * len(w) // 90):
                w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
            rows.append((10_000 + 100 * k + j, " ".join(w)))
    passage = " ".join(longest[0][1].split()[:60])
    rows += [(20_000 + k, f"intro{k} {passage} outro{k} " + " ".join(f"u{k}x{i}" for i in range(30))) for k in range(40)]
    rows += [(30_000 + k, "the same copy of a text that fills a third " * 4) for k in range(120)]
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS), rows


def test_exact_groups(spark):
    rows = clashing(awkward(spark))
    got = dedup.exact_groups(rows).collect()
    assert len(got) == rows.count()
    texts = [(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in rows.collect()]
    for r in got:
        assert any(r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in texts if i == r["doc_id"])
    by = {}
    for i, t in texts:
        by.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(i)
    for r in got:
        ids = by[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in got) == len(by)
    kept = dedup.drop_copies(rows)
    assert kept.columns == rows.columns and kept.count() == len(by)
    assert dedup.exact_groups(empty(spark)).count() == dedup.drop_copies(empty(spark)).count() == 0


def test_merge_levels_give_the_same_roots(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    rows = dedup.digests(docs)
    roots = [sorted(map(tuple, dedup.merge_runs(rows, lanes, fan).collect())) for lanes, fan in ((1, 1), (5, 1), (8, 3))]
    assert roots[0] == roots[1] == roots[2]


def test_near_groups_equal_brute_force(spark, sf):
    docs, rows = with_copies(spark, sf)
    for k in (4, 5):
        want = components(rows, k)
        got = near_dedup.near_groups(docs, words=k).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert all(r["n_shingles"] == len(shingles(t, k)) for r, t in [(r, dict(rows)[r["doc_id"]]) for r in got])
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = near_dedup.drop_near_copies(docs, words=5)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c in want.items() if i == c} and kept.columns == docs.columns


def test_near_dedup_awkward(spark):
    rows = clashing(awkward(spark))
    got = near_dedup.near_groups(rows, words=4)
    assert got.count() == rows.count()
    blank = {r["doc_id"]: r for r in got.where("n_shingles = 0").collect()}
    assert blank.keys() == {1, 2, 3} and all(r["kept"] and r["component_id"] == i for i, r in blank.items())
    assert {r["component_id"] for r in got.where("doc_id IN (4, 5) OR doc_id IS NULL").collect()} == {4}
    assert {r["component_id"] for r in got.where("doc_id IN (7, 8, 9, 13)").collect()} == {7}
    kept = near_dedup.drop_near_copies(rows, words=4)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 7, 10, 11, 12, 14, 15, 16, 17, 18}
    assert near_dedup.near_groups(empty(spark)).count() == near_dedup.drop_near_copies(empty(spark)).count() == 0


def test_bounds_never_refuse_a_link(spark):
    draw = random.Random(11)
    made = near_dedup.Shingler(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(200):
        w = list(base)
        for _ in range(draw.randrange(40)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(10**6)}"
        a, b = made.shingles(" ".join(base)), made.shingles(" ".join(w))
        common = len(set(a.tolist()) & set(b.tolist()))
        rows.append((len(a), len(b), made.parity(a).view("int64").tolist(), made.parity(b).view("int64").tolist(),
                     100 * common >= 80 * (len(a) + len(b) - common)))
    df = spark.createDataFrame(rows, "n long, m long, s array<long>, t array<long>, linked boolean")
    seen = df.withColumn("could", near_dedup.could_link("n", "m", "s", "t", 80))
    assert seen.where("linked AND NOT could").isEmpty() and not seen.where("NOT could").isEmpty()


@pytest.mark.parametrize("window", [35, 6, 1])
def test_substrings_equal_brute_force(spark, sf, window):
    docs, rows = with_copies(spark, sf)
    extra = [(40_000, ("a b c d " * 30).strip()), (40_001, " ".join(f"q{i % 20}" for i in range(100))), (40_002, "x " * 34), (40_003, None)]
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, None, 0) for i, t in extra], DOCS))
    want = {i: (n, k) for i, n, k in repeats_removed(rows + extra, window)}
    got = substrings.remove_repeats(docs, window, pack_bytes=20_000).collect()
    assert {r["doc_id"]: (r["n_words"], r["kept"]) for r in got} == want
    assert all(r["n_removed"] == r["n_words"] - len(r["kept"].split()) for r in got)


def test_substrings_awkward(spark):
    rows = clashing(awkward(spark))
    got = substrings.remove_repeats(rows).collect()
    want = sorted((repr(x) for x in repeats_removed([(r["doc_id"], r["text"]) for r in rows.collect()], 35)))
    assert sorted(repr((r["doc_id"], r["n_words"], r["kept"])) for r in got) == want
    assert substrings.remove_repeats(empty(spark)).count() == 0
