"""Logged refresh jobs over stored tables."""

import uuid
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims import schemas
from medclaims.operators import fact, marts, quality
from medclaims.plans import star
from medclaims.plans.star import Layers
from medclaims.sources import csv_load
from medclaims.sources.tables import TableStore

ETL_JOB_LOG = "ETL_JOB_LOG"
DATA_QUALITY_LOG = "DATA_QUALITY_LOG"
LOAD_RESULT = "LOAD_RESULT"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class JobContext:
    """The tables a job works on, its clock, and where its logs are if not beside the tables."""

    store: TableStore
    clock: Callable[[], datetime] = utc_now
    logs: TableStore | None = None

    def __post_init__(self):
        self.logs = self.logs or self.store

    @property
    def layers(self) -> Layers:
        return Layers(self.store)

    @property
    def job_log(self) -> DataFrame:
        return self.logs.read(ETL_JOB_LOG, schemas.ETL_JOB_LOG)

    @property
    def quality_log(self) -> DataFrame:
        return self.logs.read(DATA_QUALITY_LOG, schemas.DATA_QUALITY_LOG)


@dataclass
class JobResult:
    """What a job did. ``counts`` holds more than the logged ``rows_processed``."""

    message: str
    ok: bool
    rows_processed: int | None = None
    counts: dict[str, int] = field(default_factory=dict)


def new_run_id() -> str:
    return uuid.uuid4().hex


def _next_id(log: DataFrame, column: str) -> int:
    return log.agg(F.coalesce(F.max(column), F.lit(0)) + 1).first()[0]


def log_id(start: datetime, run_id: str) -> int:
    """L1: a number that orders runs by start, and by run id within a millisecond; the log is not read for it."""
    millis = int((start - datetime(1970, 1, 1)).total_seconds() * 1000)
    return (millis << 20) | (zlib.crc32(run_id.encode()) >> 12)


def log_transition(ctx: JobContext, run_id: str, job: str, start: datetime, status: str, **values) -> bool:
    """L1: append one row; the log is never updated in place.

    A run enters each status once, so a transition that is written again adds nothing.
    """
    row = {"job_name": job, "start_time": start, "status": status, "run_id": run_id, **values}
    row["log_id"] = log_id(start, run_id)
    record = tuple(row.get(name) for name in schemas.ETL_JOB_LOG.names)
    rows = ctx.store.spark.createDataFrame([record], schemas.ETL_JOB_LOG).coalesce(1)
    return ctx.logs.append(ETL_JOB_LOG, rows, f"{run_id}-{status}")


def _run_logged(
    ctx: JobContext, job: str, work: Callable[[], tuple[int, dict[str, int]]], text: str, strict: bool
) -> JobResult:
    """RUNNING, then SUCCESS or FAILED. A failure is returned as text; ``strict`` raises it too.

    The job's tables appear together when it has succeeded.
    """
    start, run_id = ctx.clock(), new_run_id()
    log_transition(ctx, run_id, job, start, V.RUNNING)
    try:
        with ctx.store.scope(), ctx.store.transaction():
            rows, counts = work()
    except Exception as error:
        log_transition(ctx, run_id, job, start, V.FAILED, end_time=ctx.clock(), error_message=str(error))
        if strict:
            raise
        return JobResult(V.TEXT_JOB_FAILED.format(error=error), ok=False)
    log_transition(ctx, run_id, job, start, V.SUCCESS, end_time=ctx.clock(), rows_processed=rows)
    return JobResult(text.format(rows=rows), True, rows, counts)


def load_dim_patients(ctx: JobContext, dedup: str = "literal", strict: bool = False) -> JobResult:
    """Rebuild the patient dimension from the beneficiary table. Rows that were there keep their keys."""
    def work():
        layers = Layers(ctx.store, dedup)
        layers.build(star.DIM_PATIENTS)
        rows = layers.table(star.DIM_PATIENTS).count()
        return rows, {star.DIM_PATIENTS: rows}

    return _run_logged(ctx, V.JOB_PATIENTS, work, V.TEXT_PATIENTS_LOADED, strict)


def load_fact_claims(ctx: JobContext, strict: bool = False) -> JobResult:
    """R2: rebuild the fact, both sides in one replace.

    ``rows_processed`` counts the outpatient rows only, as the source system's
    second insert does; ``counts`` has both sides.
    """
    def work():
        dimensions = fact.Dimensions(
            *[ctx.store.read(name) for name in (star.DIM_PATIENTS, star.DIM_PROVIDERS, star.DIM_DIAGNOSES)]
        )
        claims = fact.fact_claims(
            ctx.store.read(star.INPATIENT_CLAIMS), ctx.store.read(star.OUTPATIENT_CLAIMS), dimensions, ctx.store
        )
        stored = ctx.store.replace(star.FACT_CLAIMS, claims, star.PARTITIONED_BY[star.FACT_CLAIMS])
        found = {row["claim_type"]: row["count"] for row in stored.groupBy("claim_type").count().collect()}
        counts = {kind: found.get(kind, 0) for kind in (V.INPATIENT, V.OUTPATIENT)}
        return counts[V.OUTPATIENT], counts

    return _run_logged(ctx, V.JOB_FACT, work, V.TEXT_FACT_LOADED, strict)


def refresh_marts(ctx: JobContext, variant: str = "full", strict: bool = False) -> JobResult:
    """Rebuild the three marts.

    ``variant="full"`` has ranks and total days; ``variant="etl"`` leaves them
    out, as the source system's refresh job does.
    """
    if variant not in ("full", "etl"):
        raise ValueError(f"variant is 'full' or 'etl', not {variant!r}")
    full = variant == "full"

    def work():
        claims = ctx.store.read(star.FACT_CLAIMS)
        dates = ctx.store.read(star.DIM_DATE)
        diagnoses = ctx.store.read(star.DIM_DIAGNOSES)
        providers = ctx.store.read(star.DIM_PROVIDERS)
        monthly = marts.mart_monthly(claims, dates, diagnoses)
        ctx.store.replace(star.MART_MONTHLY, monthly if full else marts.mart_monthly_etl(monthly))
        if full:
            ctx.store.replace(star.MART_DIAGNOSIS, marts.mart_diagnosis(claims, diagnoses, ctx.store))
            ctx.store.replace(star.MART_PROVIDER, marts.mart_provider(claims, providers, ctx.store))
        else:
            ctx.store.replace(star.MART_DIAGNOSIS, marts.mart_diagnosis_etl(claims, diagnoses))
            ctx.store.replace(star.MART_PROVIDER, marts.mart_provider_etl(claims, providers))
        return len(star.MART_TABLES), {}

    return _run_logged(ctx, V.JOB_MARTS, work, V.TEXT_MARTS_REFRESHED, strict)


def run_pipeline(
    ctx: JobContext, strict: bool = False, dedup: str = "literal", variant: str = "full"
) -> JobResult:
    """Patients (by ``dedup``), fact, marts (in ``variant``), in this order.

    All tables appear in one step at the end, so no reader joins a new fact to old
    patients. Each job turns its failure into text, so by default the pipeline goes on
    with the table as it was and reports success, as the source system does. ``strict`` stops
    at the first failure and reports it; then the jobs before it are logged
    as they ended, but all tables stay as they were. Versions that were replaced
    more than a day ago are removed.
    """
    results = {}
    try:
        with ctx.store.transaction():
            results[V.JOB_PATIENTS] = load_dim_patients(ctx, dedup, strict)
            results[V.JOB_FACT] = load_fact_claims(ctx, strict)
            results[V.JOB_MARTS] = refresh_marts(ctx, variant, strict)
        ctx.store.remove_old_versions()
    except Exception as error:
        return JobResult(V.TEXT_PIPELINE_FAILED.format(error=error), ok=False)
    return JobResult(V.TEXT_PIPELINE_DONE, ok=all(r.ok for r in results.values()))


def run_quality_checks(ctx: JobContext, by_run: bool = False) -> JobResult:
    """Q8, Q9: run the seven checks, log them, return how many passed.

    By default the text counts every check of the last five minutes; ``by_run``
    counts this run only.
    """
    run_id = new_run_id()
    try:
        now = ctx.clock()
        results = quality.quality_checks(
            ctx.store.read(star.FACT_CLAIMS), ctx.store.read(star.DIM_PATIENTS)
        )
        rows = quality.log_rows(results, now, _next_id(ctx.quality_log, "check_id"), run_id)
        ctx.logs.append(DATA_QUALITY_LOG, rows.coalesce(1), run_id)
        summary = quality.quality_summary(ctx.quality_log, ctx.clock(), run_id if by_run else None).first()
    except Exception as error:
        return JobResult(V.TEXT_CHECKS_FAILED.format(error=error), ok=False)
    return JobResult(
        V.TEXT_CHECKS_PASSED.format(passed=summary["passed"], total=summary["total"]),
        True,
        len(V.QUALITY_CHECKS),
        {"passed": summary["passed"], "total": summary["total"]},
    )


def load_raw(
    ctx: JobContext,
    beneficiary: csv_load.Paths,
    inpatient: Sequence[str],
    outpatient: Sequence[str],
    on_error: str = "continue",
) -> dict[str, int]:
    """Load CSV files into the raw tables; return the rejected rows of each.

    Rejected rows go to ``<table>_REJECTED`` with the reason, and ``LOAD_RESULT`` counts
    both by file. Rejected rows are counted while the good rows are written, so the
    files are read a second time only if there are any; the counts by file are
    taken from the written tables. All tables appear together.
    """
    schema_of = {
        star.BENEFICIARY_SUMMARY: (schemas.BENEFICIARY, beneficiary, [csv_load.SOURCE_FILE, csv_load.SOURCE_YEAR]),
        star.INPATIENT_CLAIMS: (schemas.INPATIENT, inpatient, [csv_load.SOURCE_FILE]),
        star.OUTPATIENT_CLAIMS: (schemas.OUTPATIENT, outpatient, [csv_load.SOURCE_FILE]),
    }
    counts, results = {}, []
    with ctx.store.transaction():
        for name, (schema, paths, sources) in schema_of.items():
            observed = Observation()
            good, rejected = csv_load.load_csv(ctx.store.spark, paths, schema, on_error, observed)
            loaded = ctx.store.replace(name, good.select(*schema.names, *sources))
            counts[name] = observed.get["rejected"]
            if not counts[name]:
                rejected = ctx.store.spark.createDataFrame([], rejected.schema)
            results.append(csv_load.load_result(name, loaded, ctx.store.replace(f"{name}_REJECTED", rejected)))
        ctx.store.replace(LOAD_RESULT, reduce(DataFrame.unionByName, results).coalesce(1))
    return counts


def build_all(ctx: JobContext, names: list[str] | None = None, dedup: str = "literal") -> None:
    """First build of the star schema and marts over loaded raw tables."""
    layers = Layers(ctx.store, dedup)
    for name in names or [*star.STAR_TABLES, *star.MART_TABLES]:
        layers.build(name)
