"""Spelling variants against brute force."""

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from helpers import LOWER, awkward, clashing, empty

from docloom.llm import spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def by_hand(rows, least_length=5, least_count=3):
    total = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = crc32(f"{doc_id}:{w}".encode()) if doc_id is not None else 1
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    n = {w: c for w, c in total.items() if len(w) >= least_length and c >= least_count}
    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n[w], len(around[w]), form[w], n.get(form[w]), root(w)) for w in n)


def as_rows(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect())


def varied(spark, seed=4):
    """Words with changed, dropped, doubled and accented letters, chains of forms, and a long run."""
    draw = np.random.default_rng(seed)
    base = ["spelling", "variant", "corpus", "lettter", "aaaaaa", "naïve", "éclairs", "ÿÿÿÿÿ", "x" * 300, "Straße"]
    words = []
    for w in base:
        words += [w] * 40 + [w.upper()] * 5
        for _ in range(30):
            k = int(draw.integers(len(w)))
            c = "abcdefzé×÷"[int(draw.integers(10))]
            words += [[w[:k] + w[k + 1:], w[:k] + c + w[k + 1:], w[:k] + c + w[k:]][int(draw.integers(3))]] * int(draw.integers(1, 20))
    words += ["chaina"] * 3 + ["chainab"] * 7 + ["chainabc"] * 20 + ["chainabcd"] * 90
    draw.shuffle(words)
    rows = [(int(i), ", ".join(words[i::57])) for i in range(57)] + [(None, " ".join(words[:200])), (3, None), (4, ""), (4, "corpus corpus-corpusĀcorpus")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows


@pytest.mark.parametrize("least_length,least_count", [(5, 3), (1, 1)])
def test_variants_as_by_hand(spark, least_length, least_count):
    df, rows = varied(spark)
    wanted = by_hand(rows, least_length, least_count)
    assert as_rows(spelling.variants(clashing(df), least_length=least_length, least_count=least_count)) == wanted
    assert sum(r[3] is not None for r in wanted) > 20 and any(r[3] is not None and r[5] != r[3] for r in wanted)


def test_awkward_and_empty(spark):
    df = awkward(spark)
    assert as_rows(spelling.variants(df)) == by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
    assert spelling.variants(empty(spark)).count() == 0


def test_full_filters_change_nothing(spark, monkeypatch):
    """Filters that pass nearly everything cost more candidates, not results."""
    df, rows = varied(spark, 9)
    monkeypatch.setattr(spelling, "FILTER_BYTES", 16)
    assert as_rows(spelling.variants(df)) == by_hand(rows)


def test_small_memory_of_counts(spark, monkeypatch):
    df, rows = varied(spark, 2)
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    assert as_rows(spelling.variants(df)) == by_hand(rows)


def test_table_of_the_test_data(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert as_rows(spelling.variants(docs)) == by_hand([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
