"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from gridcast import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or v is pd.NA:
            return None
        v = v.item() if hasattr(v, "item") else v
        return None if isinstance(v, float) and v != v else v

    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 96
    assert [(r.i, r.j) for r in rows] == sorted((r.i, r.j) for r in rows)
    assert set(df.columns) >= {"tick", "i", "j", "x", "y", "temp", "colour", "bucket"}
