import shutil
from datetime import timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.operators import dims, fact, joblog, quality
from medclaims.plans import job_runs, jobs, star
from medclaims.sources.tables import TableStore
from tests.conftest import Clock

# the log keeps a long cause whole
LONG_TEXT = "no disk " * 625


def _segments():
    return [
        {"CLM_ID": c, "SEGMENT": s, "DESYNPUF_ID": "A" if c % 2 else "B", "PRVDR_NUM": f"{c % 3:06}",
         "ICD9_DGNS_CD_1": "4280", "CLM_PMT_AMT": D(c), "CLM_FROM_DT": 20080101 + c, "CLM_THRU_DT": 20080102 + c}
        for c in range(1, 7) for s in (1, 2)
    ]


@pytest.fixture(scope="module")
def first_build(spark, raw, tmp_path_factory):
    """Raw tables and a first build of the star schema, made once."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("first")))
    segments = _segments()
    store.replace(star.BENEFICIARY_SUMMARY, raw.beneficiary(
        [{"DESYNPUF_ID": p, "BENE_BIRTH_DT": 19400101} for p in "ABC"]))
    store.replace(star.INPATIENT_CLAIMS, raw.inpatient(segments[:8]))
    store.replace(star.OUTPATIENT_CLAIMS, raw.outpatient(segments[8:]))
    jobs.build_all(jobs.JobContext(store, Clock()), star.STAR_TABLES)
    return store.root


@pytest.fixture
def ctx(first_build, store):
    """Each test works on its own copy of the first build."""
    shutil.copytree(first_build, store.root)
    return jobs.JobContext(store, Clock())


def _log(ctx):
    return [tuple(r) for r in joblog.current_state(ctx.job_log).orderBy("log_id").select(
        "job_name", "status", "rows_processed").collect()]


def test_pipeline_runs_and_logs(ctx):
    result = jobs.run_pipeline(ctx)
    assert result.message == "Full ETL pipeline completed successfully" and result.ok
    # the fact job logs its outpatient rows only, the marts job its three tables
    assert _log(ctx) == [
        ("sp_load_dim_patients", "SUCCESS", 3), ("sp_load_fact_claims", "SUCCESS", 2), ("sp_refresh_marts", "SUCCESS", 3)
    ]
    assert ctx.job_log.count() == 6
    report = joblog.log_report(ctx.job_log).collect()
    assert [r.job_name for r in report] == [V.JOB_MARTS, V.JOB_FACT, V.JOB_PATIENTS]
    assert {r.duration_sec for r in report} == {7}
    assert ctx.store.read(star.MART_DIAGNOSIS).count() == 2
    # nothing is left behind
    fs, scratch = ctx.store._fs(ctx.store.path("_scratch"))
    assert len(fs.listStatus(scratch)) == 0


def test_messages_and_counts(ctx):
    assert jobs.load_dim_patients(ctx).message == "SUCCESS: 3 patients loaded"
    result = jobs.load_fact_claims(ctx)
    assert result.message == "SUCCESS: fact table reloaded"
    assert result.counts == {"Inpatient": 4, "Outpatient": 2} and result.rows_processed == 2
    assert jobs.refresh_marts(ctx).message == "SUCCESS: all marts refreshed"


def test_refresh_variants_change_the_schema(ctx):
    jobs.refresh_marts(ctx)
    full = {name: set(ctx.store.read(name).columns) for name in star.MART_TABLES}
    jobs.refresh_marts(ctx, variant="etl")
    slim = {name: set(ctx.store.read(name).columns) for name in star.MART_TABLES}
    assert full[star.MART_MONTHLY] - slim[star.MART_MONTHLY] == {"total_utilization_days"}
    assert full[star.MART_DIAGNOSIS] - slim[star.MART_DIAGNOSIS] == {"rank_by_cost", "rank_by_volume"}
    assert full[star.MART_PROVIDER] - slim[star.MART_PROVIDER] == {"revenue_rank", "volume_rank"}


def _break(monkeypatch):
    def boom(*args):
        raise RuntimeError(LONG_TEXT)

    monkeypatch.setattr(fact, "fact_claims", boom)


def test_a_failing_job_is_logged_and_hidden(ctx, monkeypatch):
    before = sorted(map(tuple, ctx.store.read(star.FACT_CLAIMS).collect()), key=str)
    _break(monkeypatch)
    result = jobs.run_pipeline(ctx)
    assert result.message == "Full ETL pipeline completed successfully" and not result.ok
    assert _log(ctx) == [
        ("sp_load_dim_patients", "SUCCESS", 3), ("sp_load_fact_claims", "FAILED", None), ("sp_refresh_marts", "SUCCESS", 3)
    ]
    failed = ctx.job_log.where(F.col("status") == "FAILED").first()
    assert failed.error_message == LONG_TEXT and failed.end_time is not None
    # the old fact is still there, whole
    assert sorted(map(tuple, ctx.store.read(star.FACT_CLAIMS).collect()), key=str) == before


def test_strict_stops_at_the_first_failure(ctx, monkeypatch, raw):
    before = {name: ctx.store.folder(name) for name in (star.DIM_PATIENTS, star.FACT_CLAIMS, *star.MART_TABLES)}
    _break(monkeypatch)
    result = jobs.run_pipeline(ctx, strict=True)
    # no table has changed, the reloaded patients included
    assert {name: ctx.store.folder(name) for name in before} == before
    assert result.message == f"Pipeline FAILED: {LONG_TEXT}" and not result.ok
    assert [row[1] for row in _log(ctx)] == ["SUCCESS", "FAILED"]


def test_a_table_can_be_replaced_from_itself(store, spark):
    store.replace("T", spark.range(3))
    store.replace("T", store.read("T").where("id > 0"))
    assert sorted(r.id for r in store.read("T").collect()) == [1, 2]


def test_reloading_patients_keeps_their_keys(ctx):
    before = sorted(map(tuple, ctx.store.read(star.DIM_PATIENTS).collect()), key=str)
    jobs.load_dim_patients(ctx)
    assert sorted(map(tuple, ctx.store.read(star.DIM_PATIENTS).collect()), key=str) == before


def _people(raw, *names, **values):
    return raw.beneficiary([{"DESYNPUF_ID": n, "BENE_BIRTH_DT": 19400101, "BENE_HMO_CVRAGE_TOT_MONS": values.get(n)} for n in names])


def _patient_keys(ctx):
    return {r.patient_id: r.patient_key for r in ctx.store.read(star.DIM_PATIENTS).collect()}


def test_a_new_beneficiary_shifts_no_key(ctx, raw):
    """One that sorts first, one that goes and comes back: the fact loaded before stays valid."""
    before, claims = _patient_keys(ctx), ctx.store.read(star.FACT_CLAIMS)
    for names in ("0ABC", "0AC", "01ABCZ"):
        ctx.store.replace(star.BENEFICIARY_SUMMARY, _people(raw, *names))
        assert jobs.load_dim_patients(ctx, strict=True).rows_processed == len(names)
        found = _patient_keys(ctx)
        assert set(found) == set(names) and len(set(found.values())) == len(names)
        assert {n: k for n, k in found.items() if n in before} == {n: k for n, k in before.items() if n in names}
    [orphans] = quality.quality_checks(claims, ctx.store.read(star.DIM_PATIENTS), [quality.ORPHANS]).collect()
    assert orphans.records_failed == 0
    # what was given once is not given again
    assert found["0"] == 4 and sorted(found.values()) == [1, 2, 3, 4, 5, 6]


def test_a_changed_row_is_new_but_a_changed_beneficiary_is_not(ctx, raw):
    ctx.store.replace(star.BENEFICIARY_SUMMARY, _people(raw, *"ABC", B=5))
    jobs.load_dim_patients(ctx, strict=True)
    assert _patient_keys(ctx) == {"A": 1, "B": 4, "C": 3}
    years = [{"DESYNPUF_ID": n, "BENE_BIRTH_DT": 19400101, "BENE_HMO_CVRAGE_TOT_MONS": m, "src_year": 2008} for n, m in zip("ABC", (1, 2, 3))]
    for month in (0, 7):
        years[0]["BENE_HMO_CVRAGE_TOT_MONS"] = month
        ctx.store.replace(star.BENEFICIARY_SUMMARY, raw.beneficiary(years, year_column=True))
        jobs.load_dim_patients(ctx, dedup="latest", strict=True)
        found = _patient_keys(ctx)
        assert found == {"A": 5, "B": 6, "C": 7}


def test_other_dimensions_keep_their_keys_too(ctx, raw):
    before = {r.provider_id: r.provider_key for r in ctx.store.read(star.DIM_PROVIDERS).collect()}
    early = _segments()[:8] + [{"CLM_ID": 99, "SEGMENT": 1, "PRVDR_NUM": "00", "ICD9_DGNS_CD_1": "001"}]
    ctx.store.replace(star.INPATIENT_CLAIMS, raw.inpatient(early))
    for name in (star.DIM_PROVIDERS, star.DIM_DIAGNOSES):
        ctx.layers.build(name)
    found = {r.provider_id: r.provider_key for r in ctx.store.read(star.DIM_PROVIDERS).collect()}
    assert found == before | {"00": 4}
    assert {r.icd9_code: r.diagnosis_key for r in ctx.store.read(star.DIM_DIAGNOSES).collect()} == {"4280": 1, "001": 2}


def test_runs_of_one_job_with_one_start_stay_apart(store):
    """Two jobs interleaved on one log, with equal clocks; a transition that is written twice."""
    ctx = jobs.JobContext(store, Clock())
    start = ctx.clock()
    for status, end in ((V.RUNNING, None), (V.SUCCESS, start + timedelta(seconds=9))):
        for run, rows in (("run-a", 1), ("run-b", 2), ("run-a", 1)):
            values = {"end_time": end, "rows_processed": rows} if end else {}
            jobs.log_transition(ctx, run, V.JOB_FACT, start, status, **values)
    assert ctx.job_log.count() == 4
    current = joblog.current_state(ctx.job_log).collect()
    assert sorted((r.job_name, r.status, r.rows_processed) for r in current) == [(V.JOB_FACT, V.SUCCESS, 1), (V.JOB_FACT, V.SUCCESS, 2)]
    assert len({r.log_id for r in current}) == 2
    assert jobs.log_id(start, "x") < jobs.log_id(start + timedelta(milliseconds=1), "a") < 1 << 63


def test_readers_see_the_pipeline_as_one_step(ctx, monkeypatch, raw):
    """A reader that looks in while the fact is loaded finds old patients with the old fact."""
    ctx.store.replace(star.BENEFICIARY_SUMMARY, _people(raw, *"0ABC"))
    reader, seen = TableStore(ctx.store.spark, ctx.store.root), []
    load = fact.fact_claims

    def looked_at(*args):
        seen.append((reader.read(star.DIM_PATIENTS).count(), ctx.store.read(star.DIM_PATIENTS).count()))
        return load(*args)

    monkeypatch.setattr(fact, "fact_claims", looked_at)
    assert jobs.run_pipeline(ctx, strict=True).ok
    assert seen == [(3, 4)] and reader.read(star.DIM_PATIENTS).count() == 4


def test_providers_are_not_refreshed_by_the_pipeline(raw, ctx):
    late = _segments()[:8] + [{"CLM_ID": 99, "SEGMENT": 1, "DESYNPUF_ID": "A", "PRVDR_NUM": "999999"}]
    ctx.store.replace(star.INPATIENT_CLAIMS, raw.inpatient(late))
    jobs.run_pipeline(ctx)
    assert ctx.store.read(star.FACT_CLAIMS).where("claim_id = 99").first().provider_key is None
    ctx.layers.build(star.DIM_PROVIDERS)
    jobs.run_pipeline(ctx)
    assert ctx.store.read(star.FACT_CLAIMS).where("claim_id = 99").first().provider_key is not None


def test_quality_job_logs_and_sums_up(ctx):
    first = jobs.run_quality_checks(ctx)
    assert first.message == "7 / 7 checks passed"
    # a second run within five minutes is counted with the first
    assert jobs.run_quality_checks(ctx).message == "14 / 14 checks passed"
    assert jobs.run_quality_checks(ctx, by_run=True).message == "7 / 7 checks passed"
    log = ctx.quality_log.orderBy("check_id").collect()
    assert [r.check_id for r in log] == list(range(1, 22))
    assert len({r.run_id for r in log}) == 3 and len({r.check_time for r in log}) == 3
    ctx.clock.now += timedelta(hours=1)
    assert quality.latest_run(ctx.quality_log, ctx.clock()).count() == 0


def test_quality_job_reports_its_failure(store):
    result = jobs.run_quality_checks(jobs.JobContext(store, Clock()))
    assert result.message.startswith("QUALITY CHECK FAILED: ") and not result.ok


def test_logs_are_empty_before_the_first_run(store):
    context = jobs.JobContext(store, Clock())
    assert context.job_log.count() == 0 and context.quality_log.count() == 0


def test_variant_and_dedup_names(ctx):
    with pytest.raises(ValueError):
        jobs.refresh_marts(ctx, variant="other")
    assert jobs.load_dim_patients(ctx, dedup="other").message.startswith("FAILED: dedup is")


def test_one_row_per_claim_needs_unique_patients(raw, store):
    rows = [{"DESYNPUF_ID": "A", "BENE_BIRTH_DT": 19400101, "BENE_HMO_CVRAGE_TOT_MONS": y, "src_year": y}
            for y in (2008, 2009, 2010)]
    beneficiary = raw.beneficiary(rows, year_column=True)
    segments = raw.inpatient([s for s in _segments() if s["CLM_ID"] % 2])
    none = raw.outpatient([])
    providers = store.replace("V", dims.dim_providers(segments, none, store))
    codes = store.replace("G", dims.dim_diagnoses(segments, none, store))
    for dedup, copies in (("literal", 3), ("latest", 1)):
        patients = store.replace("P", dims.dim_patients(beneficiary, store, dedup))
        claims = fact.fact_claims(segments, none, fact.Dimensions(patients, providers, codes), store)
        assert claims.count() == 3 * copies
        [check] = quality.quality_checks(claims, patients, [quality.DUPLICATES]).collect()
        assert check.records_failed == 3 * (copies - 1)


@pytest.fixture
def to_load(raw, store):
    """Layers of which only the raw tables are there."""
    segments = [{**s, "DESYNPUF_ID": f"B{s['CLM_ID'] % 2 + 2}"} for s in _segments()]
    store.replace(star.BENEFICIARY_SUMMARY, raw.beneficiary(
        [{"DESYNPUF_ID": f"B{i}", "BENE_BIRTH_DT": 19400101, "src_year": 2008} for i in (2, 3)], year_column=True))
    store.replace(star.INPATIENT_CLAIMS, raw.inpatient(segments[:8]))
    store.replace(star.OUTPATIENT_CLAIMS, raw.outpatient(segments[8:]))
    return star.Layers(store)


def test_the_quality_log_builds_what_the_checks_read(spark, to_load):
    rows = job_runs.quality_log(to_load).collect()
    assert len(rows) == 14 and {r.records_checked for r in rows if r.table_name == "FACT_CLAIMS"} == {6}
    tables = TableStore(spark, to_load.store.path("jobs"))
    assert not any(tables.exists(name) for name in star.MART_TABLES)
    # a query that needs the marts finds them all the same
    counts = {r.table_name: r.row_count for r in job_runs.table_counts(to_load).collect()}
    assert counts[star.FACT_CLAIMS] == 6 and counts[star.MART_DIAGNOSIS] == 2


def test_the_failed_run_builds_the_fact_once(to_load, monkeypatch):
    built, build = [], fact.fact_claims
    monkeypatch.setattr(fact, "fact_claims", lambda *tables: built.append(1) or build(*tables))
    rows = job_runs.failed_log(to_load).collect()
    assert [(r.job_name, r.status, r.rows_processed) for r in rows] == [
        (V.JOB_MARTS, V.SUCCESS, 3), (V.JOB_FACT, V.SUCCESS, 2), (V.JOB_PATIENTS, V.FAILED, None)
    ]
    assert len(built) == 1


def test_counts_after_a_failed_reload_are_no_result(ctx, spark, monkeypatch):
    for name in (*star.MART_TABLES, *[f"{name}_REJECTED" for name in star.RAW_TABLES]):
        ctx.store.replace(name, spark.range(1))
    monkeypatch.setattr(job_runs, "_loaded", lambda layers, names: ctx)
    _break(monkeypatch)
    with pytest.raises(RuntimeError, match="^Pipeline FAILED: no disk"):
        job_runs.table_counts(None)


def test_the_pipeline_log_leaves_fact_and_marts_to_the_pipeline(to_load, monkeypatch):
    there = []

    def run(ctx, strict):
        there.append([name for name in (*star.STAR_TABLES, *star.MART_TABLES) if ctx.store.exists(name)])
        return jobs.JobResult("", ok=strict)

    monkeypatch.setattr(jobs, "run_pipeline", run)
    job_runs.pipeline_log(to_load)
    assert there == [job_runs.DIMENSIONS] * 2
