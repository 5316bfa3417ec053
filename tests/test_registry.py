"""Every query with SQL gives the same rows in DuckDB; the others give rows with a stable schema."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
ORACLE = oracle_sql()
#: Whole trainings, whose library code has tests of its own (test_models, test_ensembles).
SLOW = {"m03_calibrated_svm", "m04_random_forest", "m05_bagging", "m05_feature_bagging", "m16_stacking", "m19_grid_search", "e24_feature_importances",
        "e26_experiment", "io07_saved_model", "io07_saved_bagged_trees", "io07_saved_svm", "io07_saved_stack"}
#: The training-data queries are tested in tests/llm.
OWN = {q for q in queries() if q not in SLOW and not q.startswith("op") and q != "pipeline"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(OWN & set(ORACLE)))
def test_same_as_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(OWN - set(ORACLE)))
def test_gives_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())
