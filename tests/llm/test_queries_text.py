"""The text queries on the driver's tables: against their SQL where there is any."""

import os

import duckdb
import pytest
from gridtide.llm.oracles import ORACLES
from gridtide.llm.queries import registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_there_is_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in registered()] == list(range(1, 14))
    assert set(ORACLES) <= set(registered())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, want = registered()[name](spark, SF), connection.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in names) for r in df.collect())
    places = [want.columns.index(c) for c in names]
    assert got == sorted(tuple(str(r[i]) for i in places) for r in want.fetchall()) and got
