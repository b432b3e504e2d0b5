"""Every registered query against its SQL in DuckDB, on the smallest data."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from medclaims.plans.queries import QUERIES
from oracle_queries import ORACLE_SQL as ORACLES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    oracle = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(oracle.columns)
    types = dict(zip(oracle.columns, map(str, oracle.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    mine = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    assert mine == sorted(map(repr, oracle.select(*[f'"{c}"' for c in columns]).fetchall()))


def test_ordered_results_keep_their_order(spark, duck):
    for name in ("etl_log_report", "dq_latest", "row_counts_star", "diagnoses_by_stay", "monthly_trend_inpatient"):
        mine = [tuple(r) for r in QUERIES[name](spark, SF_DIR).collect()]
        columns = [f'"{c}"' for c in QUERIES[name](spark, SF_DIR).columns]
        assert mine == duck.sql(ORACLES[name]).select(*columns).fetchall()


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 36
