"""The queries that SQL can express, against DuckDB."""

import pytest

from stratum.llm import queries
from tests.test_entry import ordered


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_against_sql(spark, name, sf):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf{sf}/{table}.parquet'")
    got = queries.QUERIES[name](spark, f"/root/testdata/sf{sf}")
    expected = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    rows = ordered(columns, expected.fetchall())
    assert rows and ordered(got.columns, got.collect()) == rows
