"""The registered queries: names, SQL, and equality with DuckDB on small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import brute
from hirelake.llm.catalog import QUERIES


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{brute.SMALL}/{table}.parquet')")
    res = con.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, brute.SMALL)
    assert df.columns == res.columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, map(tuple, res.fetchall())))
