"""Every query of the engine against its SQL."""

import math
import os

import duckdb
import pytest

from helixlake.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, con, name):
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda r: tuple(map(repr, r))
    rows = lambda every: sorted((tuple(map(plain, r)) for r in every), key=key)
    assert rows(map(tuple, got.select(*want.columns).collect())) == rows(want.fetchall())
