from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from medclaims import fixed_values as V
from medclaims import schemas
from medclaims.operators import joblog, quality
from tests.conftest import frame


@pytest.fixture
def patients(spark):
    rows = [(1, 40), (2, -1), (3, 121), (4, 120), (5, 0), (6, None)]
    return spark.createDataFrame(rows, "patient_key bigint, age_at_2010 int")


def _fact(raw):
    rows = [
        dict(claim_id=1, patient_key=1, primary_diagnosis_key=1, claim_payment_amount=D("-0.01"),
             claim_from_date_key=20080101, claim_thru_date_key=20071231),
        dict(claim_id=1, patient_key=99, primary_diagnosis_key=None, claim_payment_amount=D("0.00"),
             claim_from_date_key=20071231, claim_thru_date_key=20080101),
        dict(claim_id=1, patient_key=None, primary_diagnosis_key=1, claim_payment_amount=None,
             claim_from_date_key=20110101, claim_thru_date_key=None),
        dict(claim_id=2, patient_key=99, primary_diagnosis_key=1, claim_payment_amount=D("5.00"),
             claim_from_date_key=None, claim_thru_date_key=20080101),
        dict(claim_id=None, patient_key=2, primary_diagnosis_key=1, claim_payment_amount=D("5.00"),
             claim_from_date_key=20101231, claim_thru_date_key=20101231),
        dict(claim_id=None, patient_key=2, primary_diagnosis_key=1, claim_payment_amount=D("5.00"),
             claim_from_date_key=20101231, claim_thru_date_key=20101231),
    ]
    return raw.fact([{"claim_type": "Inpatient", **row} for row in rows])


FAILURES = {1: 1, 2: 1, 3: 3, 4: 3, 5: 1, 6: 2, 7: 2}


def test_all_checks(raw, patients):
    rows = {r.position: r for r in quality.quality_checks(_fact(raw), patients).collect()}
    assert {p: r.records_failed for p, r in rows.items()} == FAILURES
    assert [(rows[p].check_name, rows[p].table_name, rows[p].details) for p in range(1, 8)] == V.QUALITY_CHECKS
    assert all(r.records_checked == 6 for r in rows.values())
    assert rows[1].failure_rate == D("16.67") and rows[3].failure_rate == D("50.00")
    assert {r.status for r in rows.values()} == {"FAIL"}


@pytest.mark.parametrize("position", quality.ALL_CHECKS)
def test_single_checks_agree_with_the_full_run(raw, patients, position):
    [row] = quality.quality_checks(_fact(raw), patients, [position]).collect()
    assert (row.position, row.records_checked, row.records_failed) == (position, 6, FAILURES[position])


def test_empty_tables_pass_without_a_rate(raw, patients):
    rows = quality.quality_checks(raw.fact([]), patients.limit(0)).collect()
    assert {(r.status, r.records_checked, r.records_failed, r.failure_rate) for r in rows} == {("PASS", 0, 0, None)}
    assert len(rows) == 7


NOW = datetime(2024, 5, 1, 12, 0, 0)


def _log(spark, rows):
    return frame(spark, schemas.DATA_QUALITY_LOG, [
        dict(check_id=i, check_name=name, check_time=NOW - timedelta(seconds=age), status=status, table_name="FACT_CLAIMS",
             records_failed=failed, run_id=run)
        for i, (name, age, status, failed, run) in enumerate(rows, 1)
    ])


def test_reports(spark):
    log = _log(spark, [
        ("a", 400, "FAIL", 9, "r0"), ("a", 300, "PASS", 0, "r1"), ("b", 300, "FAIL", 4, "r1"),
        ("a", 10, "PASS", 0, "r2"), ("b", 10, "PASS", 0, "r2"), ("b", -5, "PASS", 0, "r3"),
    ])
    # two runs within five minutes are counted together, unless asked by run
    [summary] = quality.quality_summary(log, NOW).collect()
    assert (summary.passed, summary.total, summary.summary) == (3, 4, "3 / 4 checks passed")
    assert quality.quality_summary(log, NOW, "r2").first().summary == "2 / 2 checks passed"
    assert [r.check_name for r in quality.latest_run(log, NOW).collect()] == ["a", "b", "a", "b"]
    history = {r.check_name: tuple(r)[1:] for r in quality.check_history(log).collect()}
    assert history == {"a": (3, 2, 1, 9), "b": (3, 2, 1, 4)}


def test_job_log_views(spark):
    start = datetime(2024, 5, 1, 8, 0, 0)
    rows = [
        dict(log_id=1, job_name="x", start_time=start, status="RUNNING"),
        dict(log_id=2, job_name="y", start_time=start, status="RUNNING"),
        dict(log_id=3, job_name="x", start_time=start, end_time=start + timedelta(seconds=90), status="SUCCESS",
             rows_processed=5),
        dict(log_id=4, job_name="x", start_time=start + timedelta(hours=1), status="RUNNING"),
        dict(log_id=5, job_name="x", start_time=start + timedelta(hours=1), end_time=start + timedelta(hours=2),
             status="FAILED", error_message="boom"),
    ]
    log = frame(spark, schemas.ETL_JOB_LOG, rows)
    state = {r.log_id: (r.job_name, r.status, r.rows_processed, r.error_message)
             for r in joblog.current_state(log).collect()}
    assert state == {1: ("x", "SUCCESS", 5, None), 2: ("y", "RUNNING", None, None), 4: ("x", "FAILED", None, "boom")}
    report = [(r.job_name, r.status, r.duration_sec) for r in joblog.log_report(log).collect()]
    assert report == [("x", "FAILED", 3600), ("y", "RUNNING", None), ("x", "SUCCESS", 90)]
