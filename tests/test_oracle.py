"""Every query with SQL: Spark and DuckDB agree on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(cell, v)) + "]"
    return str(v)


def canonical(names, data):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in at) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, cur.fetchall())


def test_registry_is_consistent():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
