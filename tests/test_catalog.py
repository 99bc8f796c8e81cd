"""Every query against its oracle SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
ORACLES = {k: v for k, v in __spark_entry__.oracle_sql().items() if not k.startswith("op")}


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if value is not None and not isinstance(value, (int, bool, str)) else value


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in os.listdir(DATA):
        db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return db


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
