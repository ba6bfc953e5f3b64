"""Every query of the catalog against its SQL in DuckDB."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from lumenprep.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, (list, tuple, np.ndarray)):
        return str([plain(y) for y in x])
    if x is None or x is pd.NA or isinstance(x, float) and x != x:
        return "NULL"
    return str(int(x)) if isinstance(x, (float, np.floating)) and x == int(x) else str(x)


def rows(df, columns):
    return sorted(tuple(map(plain, r)) for r in df[columns].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
