"""Every query with SQL against DuckDB, on the small tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

from quorumtext.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "null"
    if hasattr(v, "tolist") and not isinstance(v, (list, str)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, float):
        return "null" if v != v else str(int(v)) if v == int(v) else repr(round(v, 6))
    return str(v)


def rows(frame: pd.DataFrame):
    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4
