"""Every query of the library against its DuckDB form."""

import decimal
import glob
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

from docroute.plans import registry


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 6))
    return str(v)


def rows(df, columns):
    return Counter(tuple(map(plain, r)) for r in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(registry.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)
