"""What the physical plans must and must not contain."""

import re

import pytest

from medclaims.operators import dims, fact, marts, quality
from medclaims.operators.keys import with_surrogate_key
from medclaims.plans import star
from medclaims.plans.queries import QUERIES
from medclaims.plans.star import derived_layers

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    return derived_layers(spark, SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_compares_all_pairs(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Python" not in text


def _tables(layers):
    ip, op = layers.table(star.INPATIENT_CLAIMS), layers.table(star.OUTPATIENT_CLAIMS)
    return ip, op, layers.dimensions()


def test_codes_take_two_narrow_scans(layers):
    ip, op, _ = _tables(layers)
    text = plan(dims.diagnosis_codes(ip, op))
    assert text.count("FileScan parquet") == 2 and text.count("Exchange") == 1
    assert sorted(len(s.split(",")) for s in re.findall(r"FileScan parquet \[(.*?)\]", text)) == [3, 5]


def test_providers_take_one_shuffle_and_no_join(layers):
    ip, op, _ = _tables(layers)
    text = plan(dims.provider_totals(ip, op))
    assert text.count("Exchange") == 1 and "Join" not in text
    assert text.count("PushedFilters: [IsNotNull(PRVDR_NUM)]") == 2


def _outpatient_plan(spark, op, keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(fact.fact_outpatient(op, keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_claims_are_multiplied_last_where_patients_have_many_rows(spark, layers, monkeypatch):
    _, op, keys = _tables(layers)
    monkeypatch.setattr(fact, "MANY_ROWS", 1.0)
    text = _outpatient_plan(spark, op, keys)
    # nothing depends on a broadcast
    assert "BroadcastHashJoin" not in text and "SinglePartition" not in text and "Expand" not in text
    # three look-ups below the roll-up, the beneficiaries' other rows above it
    above, below = text.split("HashAggregate", 1)
    assert above.count("SortMergeJoin") == 1 and below.count("SortMergeJoin") == 4
    # the roll-up is on integer keys, and its first shuffle is spread by segment, too
    assert re.search(r"hashpartitioning\(CLM_ID#\S+, patient_key#\S+, provider_key#\S+, primary_diagnosis_key#\S+, SEGMENT#", text)
    # rows without an id are dealt out
    for column in ("DESYNPUF_ID", "PRVDR_NUM", "ICD9_DGNS_CD_1", "patient_key"):
        assert re.search(rf"hashpartitioning\(coalesce\({column}#\d+L?, ", text)


def test_segments_are_multiplied_where_patients_have_few_rows(spark, layers):
    _, op, keys = _tables(layers)
    assert 1.5 < keys.rows_per_patient < fact.MANY_ROWS
    text = _outpatient_plan(spark, op, keys)
    assert text.count("SortMergeJoin") == 3 and "Join" not in text.split("SortMergeJoin", 1)[0]
    for column in ("DESYNPUF_ID", "PRVDR_NUM", "ICD9_DGNS_CD_1"):
        assert re.search(rf"hashpartitioning\(coalesce\({column}#\d+L?, ", text)


def test_both_fact_plans_give_the_same_rows(layers, monkeypatch):
    ip, op, keys = _tables(layers)
    expected = sorted(map(str, layers.table(star.FACT_CLAIMS).collect()))
    monkeypatch.setattr(fact, "MANY_ROWS", 1.0)
    rebuilt = fact.fact_claims(ip, op, keys, layers.store).select(*fact.FACT_COLUMNS)
    assert sorted(map(str, rebuilt.collect())) == expected


def test_results_do_not_depend_on_broadcasts(spark, layers):
    ip, op, keys = _tables(layers)
    expected = sorted(map(str, layers.table(star.FACT_CLAIMS).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rebuilt = fact.fact_claims(ip, op, keys, layers.store).select(*fact.FACT_COLUMNS)
        assert sorted(map(str, rebuilt.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marts_do_not_multiply_rows(layers):
    claims = layers.table(star.FACT_CLAIMS)
    monthly = plan(marts.mart_monthly(claims, layers.table(star.DIM_DATE), layers.table(star.DIM_DIAGNOSES)))
    provider = plan(marts.mart_provider_etl(claims, layers.table(star.DIM_PROVIDERS)))
    diagnosis = plan(marts.mart_diagnosis_etl(claims, layers.table(star.DIM_DIAGNOSES)))
    for text in (monthly, provider, diagnosis):
        assert "Expand" not in text and "SinglePartition" not in text
    assert "claim_type" in re.search(r"PartitionFilters: \[(.*?)\]", provider).group(1)
    # a hot group is shuffled together with its patients first
    assert re.search(r"hashpartitioning\(primary_diagnosis_key#\S+, claim_type#\S+, patient_key#", diagnosis)


def test_patients_take_one_shuffle(layers):
    """The range partitioning that sorts and numbers the rows also brings equal ones together."""
    rows = layers.table(star.BENEFICIARY_SUMMARY).select(*dims.patient_attributes(layers.table(star.BENEFICIARY_SUMMARY)))
    text = plan(rows.repartitionByRange(*rows.columns).distinct().sortWithinPartitions(*rows.columns))
    assert text.count("Exchange") == 1 and "rangepartitioning" in text and text.count("HashAggregate") == 2
    written = []
    store = layers.store
    scratch, store.scratch = store.scratch, lambda label, df: written.append(plan(df)) or scratch(label, df)
    try:
        dims.dim_patients(layers.table(star.BENEFICIARY_SUMMARY), store)
    finally:
        store.scratch = scratch
    assert [t.count("Exchange") for t in written] == [1]


def test_large_ranks_take_no_single_task(layers):
    text = plan(
        marts.mart_provider(layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PROVIDERS), layers.store)
    )
    # only the partition sizes, one row each, are brought together
    windows = re.findall(r"Window \[.*", text)
    assert windows and all("_rows" in window for window in windows)


def test_surrogate_keys_gather_partition_sizes_only(layers):
    keyed = with_surrogate_key(layers.spark.range(1000).toDF("id"), "key", ["id"], layers.store)
    text = plan(keyed)
    assert text.count("SinglePartition") == 1
    assert "sum(_rows" in re.search(r"Window \[(.*)", text).group(1)


def test_all_checks_scan_the_fact_three_times(spark, layers):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole paths
    try:
        text = plan(quality.quality_checks(layers.table(star.FACT_CLAIMS), layers.table(star.DIM_PATIENTS)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"FileScan parquet .*?ReadSchema: \S+", text)
    assert sum("FACT_CLAIMS" in s for s in scans) == 3
    assert sum("DIM_PATIENTS" in s for s in scans) == 2
