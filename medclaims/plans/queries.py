"""The registered queries: every operator over the layers of one data folder."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medclaims import fixed_values as V
from medclaims import schemas
from medclaims.operators import audit, dims, fact, feeds, joblog, marts, quality
from medclaims.plans import job_runs, star
from medclaims.plans.star import DerivedLayers, derived_layers
from medclaims.sources import csv_load, event_logs
from medclaims.sources.csv_copies import FAULTS, csv_copy

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Results leave with decimals as doubles, so that engines compare alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _over_layers(build: Callable[[DerivedLayers], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(build(derived_layers(spark, sf_dir)))


def _stored(name: str) -> Query:
    return _over_layers(lambda layers: layers.table(name))


def _calendar_with_claims(layers: DerivedLayers) -> DataFrame:
    """Every calendar day with the number of claims that start on it."""
    starts = (
        layers.table(star.FACT_CLAIMS)
        .groupBy(F.col("claim_from_date_key").alias("date_key"))
        .agg(F.count("*").alias("claims_started"))
    )
    days = layers.table(star.DIM_DATE)
    return days.join(starts, "date_key", "left").fillna(0, ["claims_started"])


def _latest_patients(layers: DerivedLayers) -> DataFrame:
    return dims.dim_patients(layers.table(star.BENEFICIARY_SUMMARY), layers.store, dedup="latest")


def _claims(layers: DerivedLayers) -> tuple[DataFrame, DataFrame]:
    return layers.table(star.INPATIENT_CLAIMS), layers.table(star.OUTPATIENT_CLAIMS)


def _fact_inpatient(layers: DerivedLayers) -> DataFrame:
    claims, keys = layers.table(star.INPATIENT_CLAIMS), layers.dimensions()
    return fact.fact_inpatient(claims, keys)


def _fact_outpatient(layers: DerivedLayers) -> DataFrame:
    claims, keys = layers.table(star.OUTPATIENT_CLAIMS), layers.dimensions()
    return fact.fact_outpatient(claims, keys)


def _monthly(layers: DerivedLayers) -> DataFrame:
    return marts.mart_monthly(*[layers.table(t) for t in (star.FACT_CLAIMS, star.DIM_DATE, star.DIM_DIAGNOSES)])


def _checks(positions=quality.ALL_CHECKS) -> Query:
    return _over_layers(
        lambda layers: quality.quality_checks(
            layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PATIENTS), positions
        )
    )


_CSV_READERS = {
    star.BENEFICIARY_SUMMARY: csv_load.read_beneficiary,
    star.INPATIENT_CLAIMS: csv_load.read_inpatient,
    star.OUTPATIENT_CLAIMS: csv_load.read_outpatient,
}


def _from_csv(layers: DerivedLayers, name: str) -> tuple[DataFrame, DataFrame]:
    """A raw table by way of its CSV copy."""
    return _CSV_READERS[name](layers.spark, [csv_copy(layers.store, name, layers.table(name))])


def _csv_good(name: str) -> Query:
    return _over_layers(lambda layers: _from_csv(layers, name)[0])


def _csv_rejected(layers: DerivedLayers) -> DataFrame:
    """The rejected rows of all copies with the text that made them unfit."""
    tell_apart = {
        star.BENEFICIARY_SUMMARY: ("DESYNPUF_ID", csv_load.SOURCE_YEAR),
        star.INPATIENT_CLAIMS: ("CLM_ID", "SEGMENT"),
        star.OUTPATIENT_CLAIMS: ("CLM_ID", "SEGMENT"),
    }
    parts = [
        _from_csv(layers, name)[1].select(
            F.lit(name).alias("table_name"), F.col(row).alias("row_id"), F.col(part).cast("string").alias("part_id"),
            F.lit(FAULTS[name][0]).alias("faulty_column"), F.col(FAULTS[name][0]).alias("faulty_text"),
        )
        for name, (row, part) in tell_apart.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _csv_load_result(layers: DerivedLayers) -> DataFrame:
    """Rows read, loaded and rejected of every CSV copy, by year where there are years, and why."""
    parts = []
    for name, schema in schemas.RAW.items():
        paths = [csv_copy(layers.store, name, layers.table(name))]
        good, rejected = csv_load.load_csv(layers.spark, paths, schema)
        parts.append(csv_load.load_result(name, good, rejected, csv_load.SOURCE_YEAR))
    return reduce(DataFrame.unionByName, parts)


def _latest(name: str) -> Query:
    return _over_layers(lambda layers: star.LatestLayers(layers).table(name))


CATEGORIES = ["Circulatory System", "Endocrine/Metabolic"]


def _feed(feed: Callable[..., DataFrame], categories: list[str] | None = None) -> Query:
    names = [star.MART_MONTHLY, star.FACT_CLAIMS, star.DIM_DATE]
    return _over_layers(
        lambda layers: feed(
            *map(layers.table, names), diagnoses=layers.table(star.DIM_DIAGNOSES), categories=categories
        )
    )


def _row_counts(names: list[str]) -> Query:
    return _over_layers(lambda layers: audit.row_counts({name: layers.table(name) for name in names}))


def _over_log(read: Callable[[SparkSession, str], DataFrame], report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(report(read(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    # sources
    "csv_beneficiary": _csv_good(star.BENEFICIARY_SUMMARY),
    "csv_inpatient": _csv_good(star.INPATIENT_CLAIMS),
    "csv_outpatient": _csv_good(star.OUTPATIENT_CLAIMS),
    "csv_rejected": _over_layers(_csv_rejected),
    "csv_load_result": _over_layers(_csv_load_result),
    # dimensions
    "dim_date": _over_layers(_calendar_with_claims),
    "dim_patients": _stored(star.DIM_PATIENTS),
    "dim_patients_latest": _over_layers(_latest_patients),
    "dim_providers": _stored(star.DIM_PROVIDERS),
    "dim_diagnoses": _stored(star.DIM_DIAGNOSES),
    "diagnosis_codes": _over_layers(lambda layers: dims.diagnosis_codes(*_claims(layers))),
    # fact
    "fact_inpatient": _over_layers(_fact_inpatient),
    "fact_outpatient": _over_layers(_fact_outpatient),
    "fact_claims": _stored(star.FACT_CLAIMS),
    "fact_claims_latest": _latest(star.FACT_CLAIMS),
    # marts
    "mart_monthly": _over_layers(_monthly),
    "mart_monthly_latest": _latest(star.MART_MONTHLY),
    "mart_monthly_etl": _over_layers(lambda layers: marts.mart_monthly_etl(_monthly(layers))),
    "mart_diagnosis": _over_layers(
        lambda layers: marts.mart_diagnosis(
            layers.table(star.FACT_CLAIMS), layers.table(star.DIM_DIAGNOSES), layers.store
        )
    ),
    "mart_diagnosis_etl": _over_layers(
        lambda layers: marts.mart_diagnosis_etl(layers.table(star.FACT_CLAIMS), layers.table(star.DIM_DIAGNOSES))
    ),
    "mart_provider": _over_layers(
        lambda layers: marts.mart_provider(
            layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PROVIDERS), layers.store
        )
    ),
    "mart_provider_etl": _over_layers(
        lambda layers: marts.mart_provider_etl(layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PROVIDERS))
    ),
    # quality checks
    "dq_negative_amounts": _checks([quality.NEGATIVE]),
    "dq_date_integrity": _checks([quality.DATE_ORDER]),
    "dq_orphan_patients": _checks([quality.ORPHANS]),
    "dq_duplicate_claims": _checks([quality.DUPLICATES]),
    "dq_null_diagnosis": _checks([quality.NO_DIAGNOSIS]),
    "dq_date_range": _checks([quality.DATE_RANGE]),
    "dq_impossible_ages": _checks([quality.AGES]),
    "dq_all": _checks(),
    # logs
    "dq_summary": _over_log(
        event_logs.quality_log, lambda log: quality.quality_summary(log, event_logs.REPORT_TIME)
    ),
    "dq_latest": _over_log(
        event_logs.quality_log, lambda log: quality.latest_run(log, event_logs.REPORT_TIME)
    ),
    "dq_history": _over_log(event_logs.quality_log, quality.check_history),
    "etl_log_current": _over_log(event_logs.job_log, joblog.current_state),
    "etl_log_report": _over_log(event_logs.job_log, joblog.log_report),
    # jobs
    "job_pipeline_log": _over_layers(job_runs.pipeline_log),
    "job_failed_log": _over_layers(job_runs.failed_log),
    "job_table_counts": _over_layers(job_runs.table_counts),
    "job_quality_log": _over_layers(job_runs.quality_log),
    # row counts
    "row_counts_raw": _row_counts(star.RAW_TABLES),
    "row_counts_star": _row_counts(star.STAR_TABLES),
    "row_counts_marts": _row_counts(star.MART_TABLES),
    # dashboard feeds
    "kpi_cards": _feed(feeds.kpi_cards),
    "kpi_cards_by_category": _feed(feeds.kpi_cards, CATEGORIES),
    "top_diagnoses_cost": _over_layers(
        lambda layers: feeds.top_diagnoses(layers.table(star.MART_DIAGNOSIS), 10, "cost")
    ),
    "top_diagnoses_volume": _over_layers(
        lambda layers: feeds.top_diagnoses(layers.table(star.MART_DIAGNOSIS), 10, "volume", V.INPATIENT)
    ),
    "diagnoses_by_stay": _over_layers(lambda layers: feeds.diagnoses_by_stay(layers.table(star.MART_DIAGNOSIS))),
    "cost_vs_utilization": _over_layers(
        lambda layers: feeds.cost_vs_utilization(layers.table(star.MART_DIAGNOSIS))
    ),
    "monthly_trend_inpatient": _feed(feeds.monthly_trend),
    "monthly_trend_by_category": _feed(feeds.monthly_trend, CATEGORIES),
    "category_drilldown": _over_layers(
        lambda layers: feeds.filter_category(layers.table(star.MART_MONTHLY), CATEGORIES)
    ),
}
