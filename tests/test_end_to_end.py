"""From CSV files to marts and checks."""

from medclaims import schemas
from medclaims.operators import audit, feeds
from medclaims.plans import jobs, star
from medclaims.sources import tpch_claims
from tests.conftest import Clock

SF_DIR = "/root/testdata/sf0.001"


def test_csv_files_to_marts(spark, store, tmp_path):
    """The derived raw tables, written out as CSV and loaded again, build the same star schema."""
    derived = {
        "inpatient": (tpch_claims.inpatient(spark, SF_DIR), schemas.INPATIENT),
        "outpatient": (tpch_claims.outpatient(spark, SF_DIR), schemas.OUTPATIENT),
    }
    people = tpch_claims.beneficiary(spark, SF_DIR)
    paths = {"beneficiary": []}
    for year in (2008, 2009, 2010):
        path = tmp_path / f"beneficiary_{year}.csv"
        people.where(f"src_year = {year}").select(*schemas.BENEFICIARY.names).toPandas().to_csv(
            path, index=False, float_format="%.0f")
        paths["beneficiary"].append(str(path))
    for name, (df, schema) in derived.items():
        path = tmp_path / f"{name}.csv"
        df.select(*schema.names).toPandas().to_csv(path, index=False, float_format="%.0f")
        paths[name] = [str(path)]
    with open(paths["inpatient"][0], "a") as file:
        file.write("too,few,fields\n")

    ctx = jobs.JobContext(store, Clock())
    rejected = jobs.load_raw(ctx, **paths)
    assert rejected == {star.BENEFICIARY_SUMMARY: 0, star.INPATIENT_CLAIMS: 1, star.OUTPATIENT_CLAIMS: 0}
    assert [r.reject_reason for r in store.read(f"{star.INPATIENT_CLAIMS}_REJECTED").collect()] == ["wrong number of fields"]
    by_file = {r.source_file: (r.rows_read, r.rows_loaded, r.rows_rejected, r.main_reason) for r in store.read(jobs.LOAD_RESULT).collect()}
    assert by_file == {
        "beneficiary_2008.csv": (150, 150, 0, None), "beneficiary_2009.csv": (150, 150, 0, None), "beneficiary_2010.csv": (150, 150, 0, None),
        "inpatient.csv": (733, 732, 1, "wrong number of fields"), "outpatient.csv": (5268, 5268, 0, None),
    }
    assert store.read(f"{star.OUTPATIENT_CLAIMS}_REJECTED").count() == 0
    jobs.build_all(ctx)

    names = [*star.RAW_TABLES, *star.STAR_TABLES, *star.MART_TABLES]
    counts = {r.table_name: r.row_count for r in audit.row_counts({n: ctx.layers.table(n) for n in names}).collect()}
    assert counts == {
        "BENEFICIARY_SUMMARY": 450, "INPATIENT_CLAIMS": 732, "OUTPATIENT_CLAIMS": 5268,
        "DIM_DATE": 1096, "DIM_PATIENTS": 244, "DIM_PROVIDERS": 117, "DIM_DIAGNOSES": 15, "FACT_CLAIMS": 2432,
        "MART_MONTHLY_CLAIMS_SUMMARY": 327, "MART_DIAGNOSIS_SUMMARY": 30, "MART_PROVIDER_PERFORMANCE": 97,
    }
    # every fact row with a calendar day is in the monthly mart
    monthly = store.read(star.MART_MONTHLY)
    fact = ctx.layers.table(star.FACT_CLAIMS)
    outside = fact.where("claim_from_date_key is null or claim_from_date_key not between 20080101 and 20101231")
    assert feeds.kpi_cards(monthly, fact, store.read(star.DIM_DATE)).first().claim_count + outside.count() == 2432
    assert jobs.run_quality_checks(ctx).message == "1 / 7 checks passed"
    assert jobs.run_pipeline(ctx, strict=True).ok
