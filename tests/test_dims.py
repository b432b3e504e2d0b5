import pytest
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.operators import dims, keys


def _patient(**values):
    return {"DESYNPUF_ID": "A", "BENE_BIRTH_DT": 19400105, "BENE_SEX_IDENT_CD": 1, "BENE_RACE_CD": 5,
            "SP_STATE_CODE": "05", "BENE_COUNTY_CD": "007", **{flag: 2 for flag in V.CONDITION_FLAGS}, **values}


def test_patient_columns(raw, store):
    df = raw.beneficiary([
        _patient(SP_CHF=1, SP_CNCR=None, SP_DIABETES=1, BENE_DEATH_DT=20100301, BENE_HI_CVRAGE_TOT_MONS=12)
    ])
    row = dims.dim_patients(df, store).first()
    assert row.patient_key == 1 and row.patient_id == "A"
    assert (row.birth_year, row.death_year, row.age_at_2010) == (1940, 2010, 70)
    assert (row.gender, row.race, row.state_code, row.county_code) == ("Male", "Hispanic", "05", "007")
    assert row.is_deceased is True
    # an unknown flag is NULL as a flag but not counted
    assert row.has_heart_failure is True and row.has_cancer is None and row.has_stroke is False
    assert row.chronic_condition_count == 2
    assert row.total_cost == 0 and row.total_inpatient_reimbursement is None
    assert len(row) == 29


def test_rows_that_differ_by_year_stay_apart(raw, store):
    rows = [_patient(BENE_HMO_CVRAGE_TOT_MONS=m) for m in (0, 0, 12)] + [_patient(DESYNPUF_ID="B")] * 3
    patients = dims.dim_patients(raw.beneficiary(rows), store).collect()
    assert sorted((r.patient_key, r.patient_id) for r in patients) == [(1, "A"), (2, "A"), (3, "B")]


def test_latest_keeps_one_row_per_beneficiary(raw, store):
    rows = [_patient(src_year=y, BENE_HMO_CVRAGE_TOT_MONS=y - 2000) for y in (2008, 2010, 2009)]
    rows += [_patient(DESYNPUF_ID="B", src_year=2008, BENE_HMO_CVRAGE_TOT_MONS=3)]
    patients = dims.dim_patients(raw.beneficiary(rows, year_column=True), store, dedup="latest").collect()
    assert sorted((r.patient_key, r.patient_id, r.total_hmo_coverage_months) for r in patients) == [
        (1, "A", 10), (2, "B", 3)
    ]


def test_latest_needs_a_year(raw, store):
    rows = raw.beneficiary([{"DESYNPUF_ID": "A", "BENE_BIRTH_DT": 19400101}], year_column=True)
    with pytest.raises(Exception, match="src_year"):
        dims.dim_patients(rows, store, dedup="latest").collect()


def test_unknown_dedup_is_refused(raw, store):
    with pytest.raises(ValueError):
        dims.dim_patients(raw.beneficiary([]), store, dedup="some")


def test_total_cost_beyond_the_raw_precision(spark, raw, store):
    from decimal import Decimal

    big = Decimal("99999999.99")
    df = raw.beneficiary([_patient(MEDREIMB_IP=big, MEDREIMB_OP=big, MEDREIMB_CAR=big)])
    assert dims.dim_patients(df, store).first().total_cost == 3 * big


def test_providers(raw, store):
    from decimal import Decimal as D

    inpatient = raw.inpatient([
        {"PRVDR_NUM": "000001", "CLM_PMT_AMT": D("10.00")},
        {"PRVDR_NUM": "000001", "CLM_PMT_AMT": D("0.01")},
        {"PRVDR_NUM": "000002", "CLM_PMT_AMT": None},
        {"PRVDR_NUM": None, "CLM_PMT_AMT": D("5.00")},
    ])
    outpatient = raw.outpatient([
        {"PRVDR_NUM": "000001", "CLM_PMT_AMT": D("-1.00")},
        {"PRVDR_NUM": "000003", "CLM_PMT_AMT": D("2.00")},
        {"PRVDR_NUM": "000003", "CLM_PMT_AMT": D("2.01")},
    ])
    got = {r.provider_id: tuple(r) for r in dims.dim_providers(inpatient, outpatient, store).collect()}
    assert got == {
        "000001": (1, "000001", "Both", 3, 2, 1, D("3.00"), D("9.01")),
        "000002": (2, "000002", "Inpatient Only", 1, 1, 0, D("0.00"), D("0.00")),
        "000003": (3, "000003", "Outpatient Only", 2, 0, 2, D("2.01"), D("4.01")),  # 2.005 rounds up
    }


def test_codes_come_from_five_and_three_columns(raw, store):
    codes = {f"ICD9_DGNS_CD_{i}": f"I{i}" for i in range(1, 11)}
    inpatient = raw.inpatient([codes, {"ICD9_DGNS_CD_2": "I1"}])
    outpatient = raw.outpatient([{f"ICD9_DGNS_CD_{i}": f"O{i}" for i in range(1, 11)}, {"ICD9_DGNS_CD_3": "I5"}])
    found = {r.icd9_code for r in dims.diagnosis_codes(inpatient, outpatient).collect()}
    assert found == {"I1", "I2", "I3", "I4", "I5", "O1", "O2", "O3"}
    keyed = dims.dim_diagnoses(inpatient, outpatient, store).collect()
    assert sorted((r.diagnosis_key, r.icd9_code) for r in keyed) == list(enumerate(sorted(found), 1))


def test_latest_has_as_many_rows_in_a_task_at_any_size(spark, raw, store, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 5)
    ids = [*[f"P{i:02}" for i in range(20)], None]
    rows = [_patient(DESYNPUF_ID=p, src_year=y, BENE_HMO_CVRAGE_TOT_MONS=y - 2000) for p in ids for y in (2009, 2010, 2008)]
    patients = dims.dim_patients(raw.beneficiary(rows, year_column=True), store, dedup="latest")
    # rows without an id are one patient
    assert [(r.patient_key, r.patient_id, r.total_hmo_coverage_months) for r in patients.sort("patient_key").collect()] == [
        (i, p, 10) for i, p in enumerate([None, *ids[:-1]], 1)
    ]
    (placed,) = store.scratch_paths()
    per_task = spark.read.parquet(placed).groupBy(F.input_file_name()).count()
    assert per_task.agg(F.max("count")).first()[0] <= 5


def test_repeated_patients_are_dealt_out_too(spark, raw, store, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 5)
    rows = [_patient(DESYNPUF_ID=f"P{i:02}") for i in range(20)] * 2
    assert dims.dim_patients(raw.beneficiary(rows), store).count() == 20
    (placed,) = store.scratch_paths()
    assert len(spark.read.parquet(placed).inputFiles()) > 4
