"""The job log (L1-L3): an append-only table of run transitions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims.functions import calendar as cal


def current_state(log: DataFrame) -> DataFrame:
    """One row per run, as if its outcome had updated its first row.

    A run is known by its ``run_id``; transitions without one, by job and start. It
    keeps its first log_id; all else comes from its newest transition: an ended one
    before a running one, then the higher log_id. A max over a struct
    combines before the shuffle, so even a hot (job, start) stays spread.
    """
    newest = F.struct(
        F.col("end_time").isNotNull().alias("ended"),
        F.col("log_id").alias("newest_id"),
        "end_time", "status", "rows_processed", "error_message",
    )
    runs = log.groupBy("run_id", "job_name", "start_time").agg(
        F.min("log_id").alias("log_id"), F.max(newest).alias("newest")
    )
    return runs.select(
        "log_id", "job_name", "start_time",
        "newest.end_time", "newest.status", "newest.rows_processed", "newest.error_message",
    )


def log_report(log: DataFrame) -> DataFrame:
    """L3, O2: runs with their duration in seconds, newest first."""
    runs = current_state(log).withColumn("duration_sec", cal.seconds_between("start_time", "end_time"))
    return runs.orderBy(F.col("start_time").desc_nulls_first(), F.col("log_id").desc()).select(
        "job_name", "status", "rows_processed", "duration_sec", "error_message"
    )
