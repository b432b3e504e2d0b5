"""Job-log and quality-log rows derived from events (FIXTURES.md part 3)."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from medclaims import schemas
from medclaims.fixed_values import QUALITY_CHECKS

REPORT_TIME = datetime(2024, 1, 15, 12, 0, 0)
EVENT_JOBS = ["load_dim_patients", "load_fact_claims", "refresh_marts"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id as e", "cast(ts as timestamp_ntz) as ts", "user_id", "event_type"
    )


def _pick(values: list[str], position: str) -> str:
    literals = ", ".join(f"'{value}'" for value in values)
    return f"get(array({literals}), cast({position} as int))"


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One finished check per event."""
    names = [name for name, _, _ in QUALITY_CHECKS]
    tables = [table for _, table, _ in QUALITY_CHECKS]
    texts = [text for _, _, text in QUALITY_CHECKS]
    rows = _events(spark, sf_dir).selectExpr(
        "e", "ts", "e % 7 as position", "case when e % 5 = 0 then 1 + e % 50 else 0 end as failed"
    )
    return rows.selectExpr(
        "e + 1 as check_id",
        f"{_pick(names, 'position')} as check_name",
        "ts as check_time",
        f"{_pick(tables, 'position')} as table_name",
        "if(e % 5 = 0, 'FAIL', 'PASS') as status",
        "1000L as records_checked",
        "failed as records_failed",
        "cast(failed * 100 / 1000BD as decimal(5,2)) as failure_rate",
        f"{_pick(texts, 'position')} as details",
        "cast(e div 7 as string) as run_id",
    ).select(*schemas.DATA_QUALITY_LOG.names)


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events start a run; the next event ends it, unless e % 10 = 8.

    The start travels to its outcome row over an equi join on the run number.
    """
    events = _events(spark, sf_dir)
    started = events.where("e % 2 = 0").selectExpr(
        "e div 2 as run", "cast(e div 2 as string) as run_id", "e", f"{_pick(EVENT_JOBS, '(e div 2) % 3')} as job_name", "ts as start_time"
    )
    running = started.selectExpr(
        "e as log_id", "job_name", "start_time", "cast(null as timestamp_ntz) as end_time",
        "'RUNNING' as status", "cast(null as bigint) as rows_processed",
        "cast(null as string) as error_message", "run_id",
    )
    ends = events.where("e % 2 = 1").selectExpr("e div 2 as run", "user_id", "event_type = 'error' as failed")
    ended = started.where("e % 10 <> 8").join(ends, "run").selectExpr(
        "e + 1 as log_id", "job_name", "start_time", "start_time + interval 90 seconds as end_time",
        "if(failed, 'FAILED', 'SUCCESS') as status", "if(failed, null, user_id) as rows_processed",
        "if(failed, 'event reported an error', null) as error_message", "run_id",
    )
    return running.unionByName(ended).select(*schemas.ETL_JOB_LOG.names)
