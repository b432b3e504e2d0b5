import random
from collections import defaultdict
from decimal import Decimal as D

import pytest

from medclaims.operators import fact as ops


def _run(raw, store, inpatient, outpatient, dims):
    return ops.fact_claims(raw.inpatient(inpatient), raw.outpatient(outpatient), dims, store)


def _segment(claim, segment, patient="A", provider="000001", code="4280", **values):
    return {"CLM_ID": claim, "SEGMENT": segment, "DESYNPUF_ID": patient, "PRVDR_NUM": provider,
            "ICD9_DGNS_CD_1": code, **values}


def test_segments_become_one_claim_with_maxima(raw, store):
    dims = raw.dimensions([("A", 1)], [("000001", 1)], [("4280", 1)])
    segments = [
        _segment(7, 1, CLM_PMT_AMT=D("100.00"), CLM_DRG_CD="099", CLM_FROM_DT=20080101, AT_PHYSN_NPI="9"),
        _segment(7, 2, CLM_PMT_AMT=D("40.00"), CLM_DRG_CD="1", CLM_FROM_DT=20080103, AT_PHYSN_NPI="10"),
        _segment(7, 2, CLM_PMT_AMT=None, CLM_UTLZTN_DAY_CNT=3),
    ]
    [row] = _run(raw, store, segments, [], dims).collect()
    # the payment is the maximum, not the sum; texts compare as texts
    assert row.claim_payment_amount == D("100.00")
    assert row.drg_code == "1" and row.attending_physician_npi == "9"
    assert row.claim_from_date_key == 20080103 and row.utilization_days == 3
    assert row.segment_count == 2
    assert (row.claim_key, row.claim_id, row.claim_type) == (1, 7, "Inpatient")


def test_outpatient_leaves_inpatient_columns_empty(raw, store):
    dims = raw.dimensions([("A", 1)], [("000001", 1)], [("4280", 1)])
    [row] = _run(
        raw, store, [],
        [_segment(7, 1, NCH_BENE_PTB_COINSRNC_AMT=D("3.00"), AT_PHYSN_NPI="1", NCH_BENE_PTB_DDCTBL_AMT=D("4.00"))],
        dims,
    ).collect()
    assert row.claim_type == "Outpatient" and row.deductible_amount == D("4.00")
    empty = ["admission_date_key", "coinsurance_amount", "utilization_days", "drg_code",
             "attending_physician_npi", "operating_physician_npi", "other_physician_npi"]
    assert all(row[name] is None for name in empty)


def test_a_beneficiary_with_two_rows_doubles_the_claim(raw, store):
    dims = raw.dimensions([("A", 1), ("A", 2)], [("000001", 1)], [("4280", 1)])
    rows = _run(raw, store, [_segment(7, 1), _segment(7, 2)], [], dims).collect()
    assert sorted((r.patient_key, r.segment_count) for r in rows) == [(1, 2), (2, 2)]


def test_segments_that_disagree_split_the_claim(raw, store):
    dims = raw.dimensions([("A", 1)], [("000001", 1), ("000002", 2)], [("4280", 1), ("486", 2)])
    segments = [_segment(7, 1), _segment(7, 2, provider="000002"), _segment(7, 3, code="486"), _segment(7, 4)]
    rows = _run(raw, store, segments, [], dims).collect()
    assert sorted((r.provider_key, r.primary_diagnosis_key, r.segment_count) for r in rows) == [
        (1, 1, 2), (1, 2, 1), (2, 1, 1)
    ]


def test_different_unknown_ids_fall_together_under_the_null_key(raw, store):
    dims = raw.dimensions([("A", 1)], [("000001", 1)], [("4280", 1)])
    segments = [
        _segment(7, 1, patient="X", CLM_PMT_AMT=D("1.00")),
        _segment(7, 1, patient="Y", CLM_PMT_AMT=D("5.00")),
        _segment(7, 2, patient=None, CLM_PMT_AMT=D("2.00")),
        _segment(7, 3),
    ]
    rows = _run(raw, store, segments, [], dims).collect()
    assert sorted((r.patient_key or 0, r.segment_count, r.claim_payment_amount) for r in rows) == [
        (0, 2, D("5.00")), (1, 1, None)
    ]


def test_an_id_that_looks_like_a_dealt_one_is_not_met(spark, raw, store):
    """Rows without an id are dealt out by a hash of their claim; an id of that text is another thing."""
    hashed = str(spark.sql("SELECT xxhash64(7L)").first()[0])
    dims = raw.dimensions([(hashed, 5)], [("000001", 1)], [("4280", 1)])
    rows = _run(raw, store, [_segment(7, 1, patient=None), _segment(8, 1, patient=hashed)], [], dims).collect()
    assert sorted((r.claim_id, r.patient_key) for r in rows) == [(7, None), (8, 5)]


def _brute_force(segments, patients, providers, codes):
    """Look up first, then group: the definition."""
    groups = defaultdict(list)
    for s in segments:
        for p in patients.get(s["DESYNPUF_ID"]) or [None]:
            key = (s["CLM_ID"], p, providers.get(s["PRVDR_NUM"]), codes.get(s["ICD9_DGNS_CD_1"]))
            groups[key].append(s)
    top = lambda rows, c: max((r[c] for r in rows if r[c] is not None), default=None)
    return {
        (*key, len({r["SEGMENT"] for r in rows if r["SEGMENT"] is not None}), top(rows, "CLM_PMT_AMT"),
         top(rows, "CLM_THRU_DT"))
        for key, rows in groups.items()
    }


@pytest.mark.parametrize("many_rows", [0.0, 100.0])
def test_against_brute_force_with_hot_values(raw, store, monkeypatch, many_rows):
    """Claims multiplied after the roll-up, and segments before it."""
    monkeypatch.setattr(ops, "MANY_ROWS", many_rows)
    rng = random.Random(5)
    patients = {f"P{i}": [2 * i, 2 * i + 1][: 1 + i % 2] for i in range(1, 8)}
    providers = {f"{i:06}": i for i in range(1, 5)}
    codes = {"4280": 1, "486": 2}
    segments = [
        {
            "CLM_ID": rng.choice([1, 1, rng.randrange(60), None]),
            "SEGMENT": rng.choice([None, *range(1, 30)]),
            "DESYNPUF_ID": rng.choice(["P1", None, "lost1", "lost2", *patients]),
            "PRVDR_NUM": rng.choice([None, "lost", *providers]),
            "ICD9_DGNS_CD_1": rng.choice([None, "lost", *codes]),
            "CLM_PMT_AMT": rng.choice([None, D(rng.randrange(-900, 900)) / 100]),
            "CLM_THRU_DT": rng.choice([None, 20080101 + rng.randrange(28)]),
        }
        for _ in range(1500)
    ]
    dims = raw.dimensions(
        [(k, key) for k, keys in patients.items() for key in keys], list(providers.items()), list(codes.items())
    )
    half = len(segments) // 2
    rows = _run(raw, store, segments[:half], segments[half:], dims).collect()
    columns = ["claim_id", "patient_key", "provider_key", "primary_diagnosis_key", "segment_count",
               "claim_payment_amount", "claim_thru_date_key"]
    for kind, part in (("Inpatient", segments[:half]), ("Outpatient", segments[half:])):
        mine = [tuple(r[c] for c in columns) for r in rows if r.claim_type == kind]
        assert len(mine) == len(set(mine))
        assert set(mine) == _brute_force(part, patients, providers, codes)
    assert sorted(r.claim_key for r in rows) == list(range(1, len(rows) + 1))


def test_claim_keys_do_not_depend_on_partitioning(spark, raw, store):
    dims = raw.dimensions([("A", 1)], [("000001", 1)], [("4280", 1)])
    segments = [_segment(c, s) for c in range(40) for s in (1, 2)]
    one = ops.fact_claims(raw.inpatient(segments).coalesce(1), raw.outpatient([]), dims, store)
    many = ops.fact_claims(raw.inpatient(segments).repartition(13), raw.outpatient([]), dims, store)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


@pytest.mark.parametrize("numbers", [[0, 1, 62], [0, 62, 63], [-1, 0, 64], [None]])
def test_segment_numbers_that_are_bits_and_others(raw, store, numbers):
    """Two unknown providers meet under NULL, so their segments are counted together."""
    dims = raw.dimensions([("A", 1), ("A", 2)], [("000001", 1)], [("4280", 1)])
    segments = [_segment(7, n, provider=p) for n in numbers for p in ("000001", "lost1", "lost2", None)]
    segments += [_segment(7, 5, provider="lost2")]
    rows = _run(raw, store, segments, segments, dims).collect()
    known = len([n for n in numbers if n is not None])
    found = {(r.claim_type, r.patient_key, r.provider_key): r.segment_count for r in rows}
    assert len(rows) == len(found) == 8
    for (_, _, provider), count in found.items():
        assert count == known + (provider is None)


def test_look_ups_shuffle_claims_and_not_segments(spark, raw):
    dims = raw.dimensions([("A", 1)], [("000001", 1)], [("4280", 1)])
    rows = ops.fact_outpatient(raw.outpatient([_segment(c, s) for c in range(9) for s in (1, 2)]), dims)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    # the segments are rolled up below the look-ups, and no shuffle is on their numbers
    assert "Aggregate [CLM_ID" in text.split("Join", 1)[1]
    assert "distinct" not in text
