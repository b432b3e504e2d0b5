"""Dimensions: calendar, patients, providers, diagnoses."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.functions import calendar as cal
from medclaims.functions import labels, measures
from medclaims.operators.keys import tasks_for, with_stable_key, with_surrogate_key
from medclaims.schemas import TOTAL
from medclaims.sources.tables import TableStore


def dim_date(
    spark: SparkSession, start: date = V.CALENDAR_START, end: date = V.CALENDAR_END
) -> DataFrame:
    """One row per day from ``start`` to ``end``; fiscal = calendar year."""
    first_day = F.lit(start)
    days = spark.range((end - start).days + 1).select(
        F.date_add(first_day, F.col("id").cast("int")).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        cal.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        cal.sunday_based_weekday(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        cal.sunday_based_weekday(day).isin(0, 6).alias("is_weekend"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )


def patient_attributes(beneficiary: DataFrame) -> list:
    """The 28 patient columns computed from one beneficiary row."""
    birth_year = cal.year_of_key("BENE_BIRTH_DT")
    amounts = ["MEDREIMB_IP", "MEDREIMB_OP", "MEDREIMB_CAR"]
    return [
        F.col("DESYNPUF_ID").alias("patient_id"),
        birth_year.alias("birth_year"),
        cal.year_of_key("BENE_DEATH_DT").alias("death_year"),
        (F.lit(V.AGE_REFERENCE_YEAR) - birth_year).alias("age_at_2010"),
        labels.label("BENE_SEX_IDENT_CD", V.SEX_LABELS).alias("gender"),
        labels.label("BENE_RACE_CD", V.RACE_LABELS).alias("race"),
        F.col("SP_STATE_CODE").alias("state_code"),
        F.col("BENE_COUNTY_CD").alias("county_code"),
        F.col("BENE_DEATH_DT").isNotNull().alias("is_deceased"),
        # a NULL flag stays NULL here but counts as unset below
        *[(F.col(raw) == 1).alias(name) for raw, name in V.CONDITION_FLAGS.items()],
        F.col("BENE_HI_CVRAGE_TOT_MONS").alias("total_hi_coverage_months"),
        F.col("BENE_SMI_CVRAGE_TOT_MONS").alias("total_smi_coverage_months"),
        F.col("BENE_HMO_CVRAGE_TOT_MONS").alias("total_hmo_coverage_months"),
        F.col("MEDREIMB_IP").alias("total_inpatient_reimbursement"),
        F.col("MEDREIMB_OP").alias("total_outpatient_reimbursement"),
        F.col("MEDREIMB_CAR").alias("total_carrier_reimbursement"),
        measures.null_safe_sum(amounts).cast(TOTAL).alias("total_cost"),
        measures.flag_count(V.CONDITION_FLAGS).alias("chronic_condition_count"),
    ]


# what a dimension's row is known by over reloads; patients by all columns unless there is one row for each
IDENTITY = {"provider_key": ["provider_id"], "diagnosis_key": ["icd9_code"]}


def identity_columns(key: str, columns: list[str], dedup: str = "literal") -> list[str]:
    if key == "patient_key":
        return ["patient_id"] if dedup == "latest" else [c for c in columns if c != key]
    return IDENTITY[key]


def _keyed(
    df: DataFrame, key: str, order_by: list[str], store: TableStore, known: DataFrame | None, dedup="literal", tasks=None
) -> DataFrame:
    if known is None:
        return with_surrogate_key(df, key, order_by, store, tasks=tasks)
    return with_stable_key(df, key, order_by, identity_columns(key, df.columns, dedup), known, store)


def dim_patients(
    beneficiary: DataFrame, store: TableStore, dedup: str = "literal", known: DataFrame | None = None
) -> DataFrame:
    """Patients with their surrogate key.

    ``dedup="literal"`` keeps every distinct row (A10), so a beneficiary whose
    yearly values differ has several keys. ``dedup="latest"`` keeps one row per
    beneficiary, that of the highest ``src_year``: a max over a struct. A row
    without a year is an error then, since any of them could be the latest.

    Spark sorts for such a max, and a task's share of the bytes says little of the rows it
    sorts, so beneficiaries are dealt out, a fixed number of rows to a task. Rows without an id
    are one group; they combine before their shuffle instead.

    A first build numbers the distinct rows where it sorts them, in one shuffle. ``known``
    are the keys given before (identity, patient_key): distinct rows keep theirs, and
    with ``latest`` beneficiaries do, whatever has changed about them.
    """
    attributes = patient_attributes(beneficiary)
    if dedup == "literal":
        patients = beneficiary.select(*attributes)
        if known is None:
            return with_surrogate_key(patients, "patient_key", patients.columns, store, distinct=True, tasks=tasks_for(beneficiary))
        patients, tasks = patients.distinct(), None
    elif dedup == "latest":
        no_year = F.raise_error(F.lit("a beneficiary row has no src_year: give the years of its files"))
        rows = beneficiary.select(*attributes, F.coalesce("src_year", no_year.cast("int")).alias("src_year"))
        names = [c for c in rows.columns if c not in ("patient_id", "src_year")]
        tasks, has_id = tasks_for(beneficiary), F.col("patient_id").isNotNull()
        newest = reduce(
            DataFrame.unionByName,
            [
                part.groupBy("patient_id").agg(F.max(F.struct("src_year", *names)).alias("newest"))
                for part in (rows.where(has_id).repartition(tasks, "patient_id"), rows.where(~has_id))
            ],
        )
        patients = newest.select("patient_id", *[f"newest.{name}" for name in names])
    else:
        raise ValueError(f"dedup is 'literal' or 'latest', not {dedup!r}")
    return _keyed(patients, "patient_key", patients.columns, store, known, dedup, tasks)


def provider_totals(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Claims and payments per provider and side.

    Both sides are counted in one aggregation over their union, which gives what
    a full outer join of two aggregates gives, with one shuffle of partial sums
    and no join.
    """
    def side(claims: DataFrame, is_inpatient: bool) -> DataFrame:
        return claims.where(F.col("PRVDR_NUM").isNotNull()).select(
            F.col("PRVDR_NUM").alias("provider_id"),
            F.lit(is_inpatient).alias("is_inpatient"),
            F.col("CLM_PMT_AMT").alias("paid"),
        )

    return (
        side(inpatient, True)
        .unionByName(side(outpatient, False))
        .groupBy("provider_id")
        .agg(
            F.count_if("is_inpatient").alias("total_inpatient_claims"),
            F.count_if(~F.col("is_inpatient")).alias("total_outpatient_claims"),
            F.coalesce(F.sum("paid"), F.lit(0)).cast(TOTAL).alias("total_payment_amount"),
        )
    )


def dim_providers(
    inpatient: DataFrame, outpatient: DataFrame, store: TableStore, known: DataFrame | None = None
) -> DataFrame:
    """V1: one row per provider number seen on either side."""
    claims = F.col("total_inpatient_claims") + F.col("total_outpatient_claims")
    providers = provider_totals(inpatient, outpatient).select(
        "provider_id",
        labels.provider_type("total_inpatient_claims", "total_outpatient_claims").alias("provider_type"),
        claims.alias("total_claims"),
        "total_inpatient_claims",
        "total_outpatient_claims",
        measures.safe_ratio(F.col("total_payment_amount"), claims).cast(TOTAL).alias("avg_claim_amount"),
        "total_payment_amount",
    )
    return _keyed(providers, "provider_key", ["provider_id"], store, known)


def diagnosis_codes(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """The distinct codes of the code columns, one scan per table."""
    def codes(claims: DataFrame, columns: list[str]) -> DataFrame:
        return claims.select(F.explode(F.array(*columns)).alias("icd9_code"))

    both = codes(inpatient, V.INPATIENT_CODE_COLUMNS).unionByName(
        codes(outpatient, V.OUTPATIENT_CODE_COLUMNS)
    )
    return both.where(F.col("icd9_code").isNotNull()).distinct()


def dim_diagnoses(
    inpatient: DataFrame, outpatient: DataFrame, store: TableStore, known: DataFrame | None = None
) -> DataFrame:
    """G1: one row per code with its text and category."""
    diagnoses = diagnosis_codes(inpatient, outpatient).select(
        "icd9_code",
        labels.diagnosis_text("icd9_code").alias("diagnosis_description"),
        labels.diagnosis_category("icd9_code").alias("diagnosis_category"),
    )
    return _keyed(diagnoses, "diagnosis_key", ["icd9_code"], store, known)
