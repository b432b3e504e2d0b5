from datetime import date
from decimal import Decimal as D

import pytest

from medclaims.operators import feeds, marts
from medclaims.operators.dims import dim_date

DIAGNOSES = [(1, "4280", "Heart Failure", "Circulatory System"), (2, "486", "Code: 486", "Respiratory System"),
             (3, "496", "COPD", "Respiratory System")]


@pytest.fixture
def dims(spark):
    diagnoses = spark.createDataFrame(
        DIAGNOSES, "diagnosis_key bigint, icd9_code string, diagnosis_description string, diagnosis_category string"
    )
    providers = spark.createDataFrame(
        [(1, "000001", "Both"), (2, "000002", "Inpatient Only"), (3, "000003", "Both")],
        "provider_key bigint, provider_id string, provider_type string",
    )
    return dim_date(spark), diagnoses, providers


def _claims(*rows):
    names = ["claim_type", "patient_key", "provider_key", "primary_diagnosis_key", "claim_from_date_key",
             "claim_payment_amount", "utilization_days"]
    return [{"claim_key": i, "claim_id": i, **dict(zip(names, row))} for i, row in enumerate(rows, 1)]


FACT = _claims(
    ("Inpatient", 1, 1, 1, 20080105, D("100.00"), 8),
    ("Inpatient", 1, 1, 1, 20080125, D("50.00"), 7),
    ("Inpatient", 2, 2, 2, 20080201, D("150.00"), None),
    ("Inpatient", None, 2, None, 20080203, None, 0),
    ("Inpatient", 3, None, 2, None, D("7.00"), 9),
    ("Inpatient", 3, 3, 3, 20110101, D("150.00"), 10),
    ("Outpatient", 1, 1, 2, 20080105, D("20.00"), None),
    ("Outpatient", 2, 3, 3, 20080106, D("20.00"), None),
)


def test_monthly(raw, dims):
    dates, diagnoses, _ = dims
    rows = marts.mart_monthly(raw.fact(FACT), dates, diagnoses).collect()
    got = {(r.month_date, r.claim_type, r.diagnosis_category): r for r in rows}
    # claims without a calendar day are left out, claims without a diagnosis stay
    assert sum(r.claim_count for r in rows) == 6
    january = got[(date(2008, 1, 1), "Inpatient", "Circulatory System")]
    assert (january.year, january.month, january.month_name) == (2008, 1, "Jan")
    assert (january.claim_count, january.unique_patients, january.total_paid) == (2, 1, D("150.00"))
    assert (january.avg_paid_per_claim, january.avg_length_of_stay, january.total_utilization_days) == (75.0, 7.5, 15)
    unknown = got[(date(2008, 2, 1), "Inpatient", None)]
    assert (unknown.claim_count, unknown.unique_patients, unknown.total_paid, unknown.avg_paid_per_claim) == (
        1, 0, None, None)
    outpatient = got[(date(2008, 1, 1), "Outpatient", "Respiratory System")]
    assert (outpatient.claim_count, outpatient.avg_length_of_stay, outpatient.total_utilization_days) == (2, None, None)
    assert len(rows[0]) == 12
    slim = marts.mart_monthly_etl(marts.mart_monthly(raw.fact(FACT), dates, diagnoses))
    assert len(slim.columns) == 11 and "total_utilization_days" not in slim.columns


def test_diagnosis_ranks(raw, dims, store):
    _, diagnoses, _ = dims
    rows = marts.mart_diagnosis(raw.fact(FACT), diagnoses, store).collect()
    got = {(r.claim_type, r.icd9_code): (r.claim_count, r.rank_by_cost, r.rank_by_volume) for r in rows}
    assert got == {
        ("Inpatient", "4280"): (2, 2, 1),
        ("Inpatient", "486"): (2, 1, 2),
        ("Inpatient", "496"): (1, 3, 3),
        ("Outpatient", "486"): (1, 1, 1),
        ("Outpatient", "496"): (1, 2, 2),
    }


def test_unknown_totals_rank_first(raw, dims, store):
    _, diagnoses, providers = dims
    fact = raw.fact(_claims(
        ("Inpatient", 1, 1, 1, 20080101, D("9.00"), 1), ("Inpatient", 1, 2, 2, 20080101, None, 1)
    ))
    top = {r.icd9_code: r.rank_by_cost for r in marts.mart_diagnosis(fact, diagnoses, store).collect()}
    assert top == {"486": 1, "4280": 2}
    revenue = {r.provider_id: r.revenue_rank
               for r in marts.mart_provider(fact, providers, store).collect()}
    assert revenue == {"000002": 1, "000001": 2}


def test_provider(raw, dims, store):
    _, _, providers = dims
    rows = marts.mart_provider(raw.fact(FACT), providers, store).collect()
    got = {r.provider_id: r for r in rows}
    # inpatient only, no claims without a provider
    assert {p: r.total_claims for p, r in got.items()} == {"000001": 2, "000002": 2, "000003": 1}
    # exactly seven days is no long stay; an unknown stay stays in the denominator
    assert got["000001"].pct_long_stays == D("50.00")
    assert got["000002"].pct_long_stays == D("0.00")
    assert [got[p].revenue_rank for p in sorted(got)] == [1, 2, 3]  # all earn 150, so by id
    assert [got[p].volume_rank for p in sorted(got)] == [1, 2, 3]


def test_refresh_variants_only_lose_columns(raw, dims, store):
    _, diagnoses, providers = dims
    fact = raw.fact(FACT)
    full = marts.mart_diagnosis(fact, diagnoses, store).drop("rank_by_cost", "rank_by_volume")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, marts.mart_diagnosis_etl(fact, diagnoses).collect()))
    full = marts.mart_provider(fact, providers, store).drop("revenue_rank", "volume_rank")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, marts.mart_provider_etl(fact, providers).collect()))


def test_feeds(raw, dims, store):
    dates, diagnoses, _ = dims
    fact = raw.fact(FACT)
    monthly = marts.mart_monthly(fact, dates, diagnoses)
    mart = marts.mart_diagnosis(fact, diagnoses, store)
    [cards] = feeds.kpi_cards(monthly, fact, dates).collect()
    assert (cards.total_paid, cards.claim_count) == (D("340.00"), 6)
    # patients 1 and 2; the mart's per-group counts add up to more
    assert (cards.unique_patients_exact, cards.unique_patients_sum) == (2, 4)
    assert cards.avg_length_of_stay_exact == 5.0
    assert {r.icd9_code for r in feeds.top_diagnoses(mart, 1).collect()} == {"486"}
    assert [r.icd9_code for r in feeds.top_diagnoses(mart, 1, "volume", "Inpatient").collect()] == ["4280"]
    by_stay = [(r.claim_type, r.icd9_code, r.avg_length_of_stay) for r in feeds.diagnoses_by_stay(mart).collect()]
    assert by_stay[0] == ("Inpatient", "496", 10.0) and by_stay[-1][2] is None
    trend = feeds.monthly_trend(monthly, fact, dates).collect()
    assert [(r.month_date, r.claim_count, r.total_utilization_days) for r in trend] == [
        (date(2008, 1, 1), 2, 15), (date(2008, 2, 1), 2, 0)
    ]
    assert trend[1].avg_length_of_stay_exact == 0.0 and trend[1].stay_days_per_claim == 0.0
    assert feeds.filter_category(mart, ["Circulatory System"]).count() == 1
    [some] = feeds.kpi_cards(monthly, fact, dates, diagnoses, ["Circulatory System"]).collect()
    kept = monthly.where("diagnosis_category = 'Circulatory System'").collect()
    assert some.claim_count == sum(r.claim_count for r in kept) < 6
    assert some.unique_patients_exact <= some.unique_patients_sum == sum(r.unique_patients for r in kept)
    with pytest.raises(ValueError):
        feeds.kpi_cards(monthly, fact, dates, categories=["Circulatory System"])
    assert feeds.cost_vs_utilization(mart).count() == 5
