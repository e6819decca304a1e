"""The driver contract and the DuckDB oracle of every registered query."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from hirelake.plans.catalog import CATALOG

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
# Spark type -> DuckDB type of the same values
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "median_salary" in df.columns


def test_every_query_has_an_oracle():
    assert set(CATALOG) <= set(entry.oracle_sql())
    assert set(CATALOG) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(CATALOG)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    duck_types = dict(zip(res.columns, map(str, res.types)))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == duck_types
    assert _canon(df.columns, rows) == _canon(res.columns, res.fetchall())
