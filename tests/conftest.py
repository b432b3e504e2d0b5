import sys
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from medclaims import schemas  # noqa: E402
from medclaims.operators import fact as fact_ops  # noqa: E402
from medclaims.session import local_session  # noqa: E402
from medclaims.sources.tables import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def frame(spark, schema, rows):
    """Rows given as dicts; columns not named are NULL. By Arrow, so no Python worker rereads them."""
    columns = [pa.array([row.get(f.name) for row in rows], to_arrow_type(f.dataType)) for f in schema.fields]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


class Clock:
    """Moves on by a fixed step at every reading."""

    def __init__(self, start=datetime(2024, 1, 1, 8, 0, 0), step=timedelta(seconds=7)):
        self.now, self.step = start, step

    def __call__(self):
        self.now += self.step
        return self.now


@pytest.fixture(scope="session")
def raw(spark):
    """Builders of raw tables from dicts."""

    class Raw:
        @staticmethod
        def beneficiary(rows, year_column=False):
            df = frame(spark, schemas.BENEFICIARY, rows)
            if not year_column:
                return df
            schema = T.StructType([*schemas.BENEFICIARY.fields, T.StructField("src_year", T.IntegerType())])
            return frame(spark, schema, rows)

        @staticmethod
        def inpatient(rows):
            return frame(spark, schemas.INPATIENT, rows)

        @staticmethod
        def outpatient(rows):
            return frame(spark, schemas.OUTPATIENT, rows)

        @staticmethod
        def dimensions(patients=(), providers=(), diagnoses=()):
            def pairs(rows, names):
                schema = T.StructType([T.StructField(names[0], T.StringType()), T.StructField(names[1], T.LongType())])
                return frame(spark, schema, [dict(zip(names, row)) for row in rows])

            return fact_ops.Dimensions(
                pairs(patients, ["patient_id", "patient_key"]),
                pairs(providers, ["provider_id", "provider_key"]),
                pairs(diagnoses, ["icd9_code", "diagnosis_key"]),
            )

        @staticmethod
        def fact(rows):
            schema = T.StructType([T.StructField("claim_key", T.LongType()), *fact_ops.FACT_SCHEMA.fields])
            return frame(spark, schema, rows)

    return Raw
