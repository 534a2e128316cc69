"""Every registered query against its SQL in DuckDB, over whole tables."""

import math
import os

import duckdb
import pytest

from orrery.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got
    if name in SQL:
        found = duck.sql(SQL[name])
        assert sorted(found.columns) == columns
        assert got == sorted(tuple(map(plain, r)) for r in found.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry_lists_the_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
