"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bool, int, float)):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T00:00:00", "")
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def names():
    return [n for n in entry.queries() if n != "pipeline" and not n.startswith("op")]


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    assert table(got.columns, rows) == table(list(want.columns), want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
