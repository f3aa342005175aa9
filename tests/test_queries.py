"""Every query with SQL against DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from boxwright.plans import catalog, more  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(catalog.SQL[name])
    cols = sorted(want.columns)
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    at = [want.columns.index(c) for c in cols]
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
