"""Seven data-quality checks (Q1-Q8) and the reports on their log (Q9-Q11)."""

from collections.abc import Collection
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.functions import calendar as cal
from medclaims.functions import measures

NEGATIVE, DATE_ORDER, ORPHANS, DUPLICATES, NO_DIAGNOSIS, DATE_RANGE, AGES = range(1, 8)
ALL_CHECKS = range(1, 8)

# Checks that look at one fact row at a time
ROW_TESTS = {
    NEGATIVE: lambda: F.col("claim_payment_amount") < 0,
    DATE_ORDER: lambda: F.col("claim_from_date_key") > F.col("claim_thru_date_key"),
    NO_DIAGNOSIS: lambda: F.col("primary_diagnosis_key").isNull(),
    DATE_RANGE: lambda: (F.col("claim_from_date_key") < V.FIRST_CLAIM_DAY)
    | (F.col("claim_from_date_key") > V.LAST_CLAIM_DAY),
}


def _result(position: int, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        checked.cast("bigint").alias("checked"),
        failed.cast("bigint").alias("failed"),
    )


def _one_pass(table: DataFrame, tests: dict[int, Column | None]) -> DataFrame:
    """Count the rows and the failures of several tests in one scan.

    A test of None only counts rows (its failures come from elsewhere).
    """
    failing = [
        F.lit(0) if test is None else F.count_if(test) for test in tests.values()
    ]
    counts = table.agg(
        F.count("*").alias("rows"), *[f.alias(f"failed_{p}") for p, f in zip(tests, failing)]
    )
    results = [_result(p, F.col("rows"), F.col(f"failed_{p}")) for p in tests]
    return counts.select(F.inline(F.array(*results)))


def _orphans(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """Rows whose patient key is NULL or has no patient.

    Rows are counted per key before the anti join, so a hot key shrinks to one
    row before anything is shuffled. NULL keys match nothing and survive the
    anti join, which is what the check asks for.
    """
    per_key = fact.groupBy("patient_key").agg(F.count("*").alias("rows"))
    orphans = per_key.join(patients.select("patient_key"), "patient_key", "left_anti")
    found = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failed"))
    return found.select(F.inline(F.array(_result(ORPHANS, F.lit(0), F.col("failed")))))


def _duplicates(fact: DataFrame) -> DataFrame:
    """Rows beyond the first of each claim id."""
    per_claim = fact.groupBy("claim_id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    found = per_claim.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("failed"))
    return found.select(F.inline(F.array(_result(DUPLICATES, F.lit(0), F.col("failed")))))


def quality_checks(
    fact: DataFrame, patients: DataFrame, checks: Collection[int] = ALL_CHECKS
) -> DataFrame:
    """Q1-Q8, U4: one row per requested check, by ``position``.

    The row tests and the denominators share one scan of the fact; orphans and
    duplicates add one narrow aggregation each.
    """
    parts = []
    fact_tests = {
        p: ROW_TESTS[p]() if p in ROW_TESTS else None for p in checks if p != AGES
    }
    if fact_tests:
        parts.append(_one_pass(fact, fact_tests))
    if ORPHANS in checks:
        parts.append(_orphans(fact, patients))
    if DUPLICATES in checks:
        parts.append(_duplicates(fact))
    if AGES in checks:
        age = F.col("age_at_2010")
        parts.append(_one_pass(patients, {AGES: (age < 0) | (age > V.MAX_AGE)}))

    names, tables, details = zip(*V.QUALITY_CHECKS)

    def text_of(texts) -> Column:
        return F.get(F.array(*[F.lit(text) for text in texts]), F.col("position") - 1)

    counts = reduce(DataFrame.unionByName, parts).groupBy("position").agg(
        F.sum("checked").alias("records_checked"), F.sum("failed").alias("records_failed")
    )
    failed, checked = F.col("records_failed"), F.col("records_checked")
    return counts.select(
        "position",
        text_of(names).alias("check_name"),
        text_of(tables).alias("table_name"),
        F.when(failed == 0, V.PASS).otherwise(V.FAIL).alias("status"),
        "records_checked",
        "records_failed",
        measures.percent(failed, checked).cast("decimal(5,2)").alias("failure_rate"),
        text_of(details).alias("details"),
    )


def log_rows(results: DataFrame, now: datetime, first_id: int, run_id: str) -> DataFrame:
    """Results as log rows; one time stamp and one ``run_id`` for the whole run."""
    return results.select(
        (F.col("position") - 1 + first_id).cast("bigint").alias("check_id"),
        "check_name",
        F.lit(now).cast("timestamp_ntz").alias("check_time"),
        "table_name",
        "status",
        "records_checked",
        "records_failed",
        "failure_rate",
        "details",
        F.lit(run_id).alias("run_id"),
    )


def _recent(log: DataFrame, now: datetime) -> DataFrame:
    """the last five minutes up to ``now``."""
    return log.where(
        (F.col("check_time") >= cal.minutes_before(now, V.REPORT_WINDOW_MINUTES))
        & (F.col("check_time") <= F.lit(now).cast("timestamp_ntz"))
    )


def quality_summary(log: DataFrame, now: datetime, run_id: str | None = None) -> DataFrame:
    """Q9: how many checks passed, of those in the last five minutes.

    Two quick runs are counted together; with ``run_id`` only that run counts.
    """
    rows = _recent(log, now) if run_id is None else log.where(F.col("run_id") == run_id)
    counts = rows.agg(
        F.count_if(F.col("status") == V.PASS).alias("passed"), F.count("*").alias("total")
    )
    text = F.format_string(
        V.TEXT_CHECKS_PASSED.format(passed="%d", total="%d"), F.col("passed"), F.col("total")
    )
    return counts.withColumn("summary", text)


def latest_run(log: DataFrame, now: datetime) -> DataFrame:
    """Q10, O3: the checks of the last five minutes in logged order."""
    return (
        _recent(log, now)
        .orderBy("check_id")
        .select("check_name", "table_name", "status", "records_failed", "failure_rate", "details")
    )


def check_history(log: DataFrame) -> DataFrame:
    """Every check over all its runs."""
    return log.groupBy("check_name").agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == V.PASS).alias("times_passed"),
        F.count_if(F.col("status") == V.FAIL).alias("times_failed"),
        F.max("records_failed").alias("max_failures_seen"),
    )
