"""Corpus queries with SQL against DuckDB on the smallest data."""

from pathlib import Path

import duckdb
import pytest

from medclaims.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_its_oracle(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    columns = ", ".join(f'"{c}"' for c in found.columns)
    expected = duck.execute(f"SELECT {columns} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
