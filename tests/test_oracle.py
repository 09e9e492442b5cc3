"""Every query that has SQL gives DuckDB's rows on the smallest tables; every other one runs."""

import os

import duckdb
import pytest

from tenderspark.plans import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()], key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    rel = duck.sql(sql)
    at = [rel.columns.index(c) for c in cols]
    assert len(rel.columns) == len(cols)
    assert rows == sorted([tuple(plain(r[i]) for i in at) for r in rel.fetchall()], key=repr)
