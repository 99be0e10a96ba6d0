import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tablesmith.plans import assembly, commands, queries, storage  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{SF}/{name}')")
    return con


def plain(value):
    return float(value) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(dict(zip(names, r))[c]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want and got


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["season", "tier", "team"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
