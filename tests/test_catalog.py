"""Every query of the catalogue against DuckDB on the smallest supplied tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from gleanframe.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_each_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL) and set(catalog.QUERIES) <= set(__spark_entry__.queries())


def _shown(v):
    return ("nan" if math.isnan(v) else f"{v:.9g}") if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the supplied tables aren't here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows_as_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df, other = catalog.QUERIES[name](spark, DATA), con.sql(catalog.SQL[name])
    columns = sorted(df.columns)
    assert sorted(other.columns) == columns
    ours = sorted(tuple(_shown(r[c]) for c in columns) for r in df.collect())
    theirs = sorted(tuple(_shown(r[other.columns.index(c)]) for c in columns) for r in other.fetchall())
    assert ours == theirs
