"""Registered queries against their DuckDB oracle on sf0.001 (the driver
runs the same check at sf0.01), and the flagship entry point."""
import duckdb
import pytest

import __spark_entry__ as entry
from ticklake.plans import catalog
from scripts.check import TABLES, digest

from conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
