"""Every query against its SQL in DuckDB on the smallest tables, and the rest for rows."""

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from siltstone.plans import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(x):
    if isinstance(x, (list, tuple, np.ndarray)):
        return str([value(y) for y in x])
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
        return "null"
    if hasattr(x, "isoformat"):
        return x.isoformat()[:10]
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    return f"{float(x):.6f}" if isinstance(x, (int, float, np.number)) else str(x)


def normal(df):
    return sorted(tuple(map(value, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(SF)).toPandas()
    if name not in ORACLES:
        assert len(got.columns)
        return
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
