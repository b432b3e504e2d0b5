"""Whole job runs as queries.

Claims go through their CSV copies into raw tables, and layers are built, once for
all of these queries; each then runs the logged jobs on those tables, with logs
of its own and a clock that moves on by the same step at every reading. A query
builds the layers its jobs read and do not write themselves.
"""

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.operators import audit, joblog
from medclaims.plans import jobs, star
from medclaims.sources.csv_copies import csv_copy
from medclaims.sources.tables import TableStore

START = datetime(2024, 1, 1, 8)
STEP = timedelta(seconds=7)


class SteppedClock:
    def __init__(self):
        self.now = START

    def __call__(self) -> datetime:
        self.now += STEP
        return self.now


# the pipeline builds the patients anew and the fact and marts from them; should its patients' job fail, it reads those that are there
DIMENSIONS = [star.DIM_DATE, star.DIM_PATIENTS, star.DIM_PROVIDERS, star.DIM_DIAGNOSES]


def _loaded(layers: star.DerivedLayers, names: list[str]) -> jobs.JobContext:
    """Tables with at least the layers ``names``; those that are there stay."""
    store = TableStore(layers.spark, layers.store.path("jobs"))
    logs = TableStore(layers.spark, layers.store.path(f"job-logs/{uuid.uuid4().hex}"))
    ctx = jobs.JobContext(store, SteppedClock(), logs)
    if not store.exists(jobs.LOAD_RESULT):
        jobs.load_raw(ctx, *[[csv_copy(layers.store, name, layers.table(name))] for name in star.RAW_TABLES])
    missing = [name for name in names if not store.exists(name)]
    if missing:
        jobs.build_all(ctx, missing)
    return ctx


def pipeline_log(layers: star.DerivedLayers) -> DataFrame:
    """L3 after the pipeline ran twice on one set of tables."""
    ctx = _loaded(layers, DIMENSIONS)
    for _ in range(2):
        jobs.run_pipeline(ctx, strict=True)
    return joblog.log_report(ctx.job_log)


def failed_log(layers: star.DerivedLayers) -> DataFrame:
    """L3 after a pipeline whose first job is made to fail; the others go on."""
    ctx = _loaded(layers, DIMENSIONS)
    jobs.run_pipeline(ctx, dedup="none")
    return joblog.log_report(ctx.job_log)


def table_counts(layers: star.DerivedLayers) -> DataFrame:
    """S11 after the jobs reloaded tables that were there: nothing doubles."""
    ctx = _loaded(layers, [*star.STAR_TABLES, *star.MART_TABLES])
    result = jobs.run_pipeline(ctx, strict=True)
    if not result.ok:
        # the tables are as they were, and their counts would look like those of a reload
        raise RuntimeError(result.message)
    names = [*star.RAW_TABLES, *[f"{name}_REJECTED" for name in star.RAW_TABLES], *star.STAR_TABLES, *star.MART_TABLES]
    return audit.row_counts({name: ctx.store.read(name) for name in names})


def quality_log(layers: star.DerivedLayers) -> DataFrame:
    """Q8, Q9: the log of two runs, each row with its run's answer: the first
    counts itself alone, the second all of the last five minutes."""
    ctx = _loaded(layers, star.STAR_TABLES)
    alone = jobs.run_quality_checks(ctx, by_run=True).message
    both = jobs.run_quality_checks(ctx).message
    first = F.col("check_id") <= len(V.QUALITY_CHECKS)
    return ctx.quality_log.drop("run_id").withColumn("answer", F.when(first, alone).otherwise(both))
