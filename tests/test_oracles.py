"""Every query with SQL gives the SQL's rows on the smallest tables; every other one runs."""

import os

import duckdb
import pytest

from gleanery.plans import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def _plain(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    return x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DATA)
    rows = got.collect()
    if name in ORACLE_SQL:
        want = con.sql(ORACLE_SQL[name])
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        at = [want.columns.index(c) for c in columns]
        assert sorted(repr([_plain(r[c]) for c in columns]) for r in rows) == sorted(repr([_plain(r[i]) for i in at]) for r in want.fetchall())
