"""The pipeline's stages on small tables, and every query against its SQL."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from helpers import awkward, clashing, components, empty, words

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from docloom.llm import mix, quality  # noqa: E402
from docloom.llm.registry import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_pipeline_equals_its_parts_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r["doc_id"] for r in quality.verdicts(docs).where("kept").collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] in good}
    first = {}
    for i in sorted(rows):
        first.setdefault(" ".join(words(rows[i]["text"])), i)
    alone = [(i, rows[i]["text"]) for i in sorted(first.values())]
    near = components(alone, k=5)
    kept = [i for i, _ in alone if near[i] == i]
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mix.mix(docs.where(docs.doc_id.isin(kept))).collect()}
    want = Counter({i: -(-t // s) for i, (t, s) in taken.items() if t})
    got = corpus_pipeline.run(spark, sf)
    assert Counter(r["doc_id"] for r in got.collect()) == want
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("make", [awkward, empty, lambda s: clashing(awkward(s))])
def test_stages_handle_awkward_tables(spark, sf, make):
    docs = make(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.collect()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
