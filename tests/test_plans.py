"""Every query with SQL against that SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

from docketweave import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, str, bool, type(None))) else str(v)
    return sorted([tuple(value(r[i]) for i in order) for r in rows], key=repr), sorted(columns)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert got == canonical(want.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, small):
    assert QUERIES[name](spark, small).count() >= 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)
