"""The queries that SQL can express, against DuckDB."""
import duckdb
import pytest

from ticklake.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("benchmark", "conversations", "documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(oracle.SQL[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)
