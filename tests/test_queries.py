"""Every query of the catalogue against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from tomeworks.plans.catalog import ORACLES, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f).split('.')[0]} AS FROM '{f}'")
    return c


def norm(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v)


def rows(df):
    return sorted(tuple(norm(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DIR).toPandas()
    assert len(got)
    if name in ORACLES:
        want = con.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
def test_catalog_search_full(spark, con):
    """Every order searched for in every order, by joining all pairs: catalog_search's SQL without its subsets."""
    sql = ORACLES["catalog_search"].replace(" WHERE o_orderkey % 50 = 0", "")
    assert "% 50" not in sql
    got, want = QUERIES["catalog_search_full"](spark, DIR).toPandas(), con.sql(sql).df()
    assert got["query_id"].nunique() == len(con.sql("FROM orders").df())
    assert rows(got) == rows(want[got.columns])
