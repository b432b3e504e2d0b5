"""The claim fact: billing segments rolled up and given dimension keys.

What is computed: segments look up patient, provider and diagnosis keys (LEFT,
one row per matching patient row), then group by claim and the three keys.

How: a beneficiary of several patient rows multiplies segments, and all that is
done to them. Where beneficiaries have few rows on average, measured on the stored dimension,
that is done as it stands. Else the look-up gives each id *one* key, the least
of its rows; segments are rolled up on integer keys, with unknown ids under the
key NULL as they should be; and only the claims, a fraction of the segments, are
multiplied by the rows of their beneficiary. Both ways give the same rows.

In the first case segments are rolled up on their ids before the look-ups, which then shuffle
claims and not segments. The numbers of a claim's segments are kept as the bits of a BIGINT
meanwhile, which combines before the shuffle as a maximum does. Tables with a number that is no
such bit have their segments looked up and counted by DISTINCT; that gives the same rows, too.
"""

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medclaims import fixed_values as V
from medclaims.operators.keys import with_surrogate_key
from medclaims.schemas import AMOUNT
from medclaims.sources.tables import TableStore

ID_COLUMNS = ["DESYNPUF_ID", "PRVDR_NUM", "ICD9_DGNS_CD_1"]
KEY_COLUMNS = ["patient_key", "provider_key", "primary_diagnosis_key"]

# fact column -> raw column; each is the MAX over the segments (A2, A3)
INPATIENT_MEASURES = {
    "claim_from_date_key": "CLM_FROM_DT",
    "claim_thru_date_key": "CLM_THRU_DT",
    "admission_date_key": "CLM_ADMSN_DT",
    "claim_payment_amount": "CLM_PMT_AMT",
    "primary_payer_amount": "NCH_PRMRY_PYR_CLM_PD_AMT",
    "deductible_amount": "NCH_BENE_IP_DDCTBL_AMT",
    "coinsurance_amount": "NCH_BENE_PTA_COINSRNC_LBLTY_AM",
    "utilization_days": "CLM_UTLZTN_DAY_CNT",
    "drg_code": "CLM_DRG_CD",
    "attending_physician_npi": "AT_PHYSN_NPI",
    "operating_physician_npi": "OP_PHYSN_NPI",
    "other_physician_npi": "OT_PHYSN_NPI",
}
OUTPATIENT_MEASURES = {
    "claim_from_date_key": "CLM_FROM_DT",
    "claim_thru_date_key": "CLM_THRU_DT",
    "claim_payment_amount": "CLM_PMT_AMT",
    "primary_payer_amount": "NCH_PRMRY_PYR_CLM_PD_AMT",
    "deductible_amount": "NCH_BENE_PTB_DDCTBL_AMT",
}

# The target columns of the fact without its own key
FACT_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.LongType()),
        T.StructField("claim_type", T.StringType()),
        T.StructField("patient_key", T.LongType()),
        T.StructField("provider_key", T.LongType()),
        T.StructField("primary_diagnosis_key", T.LongType()),
        T.StructField("claim_from_date_key", T.IntegerType()),
        T.StructField("claim_thru_date_key", T.IntegerType()),
        T.StructField("admission_date_key", T.IntegerType()),
        T.StructField("claim_payment_amount", AMOUNT),
        T.StructField("primary_payer_amount", AMOUNT),
        T.StructField("deductible_amount", AMOUNT),
        T.StructField("coinsurance_amount", AMOUNT),
        T.StructField("utilization_days", T.IntegerType()),
        T.StructField("drg_code", T.StringType()),
        T.StructField("segment_count", T.IntegerType()),
        T.StructField("attending_physician_npi", T.StringType()),
        T.StructField("operating_physician_npi", T.StringType()),
        T.StructField("other_physician_npi", T.StringType()),
    ]
)
FACT_COLUMNS = ["claim_key", *FACT_SCHEMA.names]
# these tell all fact rows apart
FACT_ORDER = ["claim_id", "claim_type", "patient_key", "provider_key", "primary_diagnosis_key"]


# segment numbers from 0 up to this one are bits of a BIGINT
LAST_BIT = 62
_BITS = "_segments"

# patient rows of an id, on average, from which on claims are multiplied rather than segments
MANY_ROWS = 2.0


class Dimensions:
    """The three looked-up dimensions.

    They are read back from written tables, so that Spark plans each look-up
    from a known size: a broadcast below its limit, a shuffled join above.
    """

    def __init__(self, patients: DataFrame, providers: DataFrame, diagnoses: DataFrame):
        self.patients = patients.select(F.col("patient_id").alias("DESYNPUF_ID"), "patient_key")
        self.providers = providers.select(F.col("provider_id").alias("PRVDR_NUM"), "provider_key")
        self.diagnoses = diagnoses.select(
            F.col("icd9_code").alias("ICD9_DGNS_CD_1"), F.col("diagnosis_key").alias("primary_diagnosis_key")
        )

    @cached_property
    def rows_per_patient(self) -> float:
        """About how many rows an id has; it decides on the plan only, never on the result."""
        rows, ids = self.patients.agg(F.count("DESYNPUF_ID"), F.approx_count_distinct("DESYNPUF_ID")).first()
        return rows / ids if ids else 0.0

    @property
    def multiplies_claims(self) -> bool:
        return self.rows_per_patient > MANY_ROWS

    @property
    def first_rows(self) -> DataFrame:
        """One key for each patient id, the least."""
        return self.patients.where(F.col("DESYNPUF_ID").isNotNull()).groupBy("DESYNPUF_ID").agg(
            F.min("patient_key").alias("patient_key")
        )

    @property
    def all_rows(self) -> DataFrame:
        """(patient_key, own_key): all keys of each id by its least."""
        own = self.patients.withColumnRenamed("patient_key", "own_key")
        return own.join(self.first_rows, "DESYNPUF_ID").drop("DESYNPUF_ID")

    @property
    def look_ups(self) -> dict[str, DataFrame]:
        """Id column of the claims -> (id, key)."""
        patients = self.first_rows if self.multiplies_claims else self.patients
        return {"DESYNPUF_ID": patients, "PRVDR_NUM": self.providers, "ICD9_DGNS_CD_1": self.diagnoses}


def roll_up(claims: DataFrame, measures: dict[str, str], by: Sequence[str]) -> DataFrame:
    """A2, A3: one row per claim and keys; MAX of each measure, distinct segments.

    Spark plans the single DISTINCT by shuffling on (claim, keys, segment) and
    combining again before it shuffles on (claim, keys), so one claim with very
    many segments is still spread over tasks.
    """
    return claims.groupBy("CLM_ID", *by).agg(
        *[F.max(raw).alias(name) for name, raw in measures.items()],
        F.countDistinct("SEGMENT").alias("segment_count"),
    )


def segments_are_bits(claims: DataFrame) -> bool:
    """Whether the bits of a BIGINT can hold all segment numbers; on a stored table its statistics tell."""
    return claims.where((F.col("SEGMENT") < 0) | (F.col("SEGMENT") > LAST_BIT)).isEmpty()


def roll_up_bits(claims: DataFrame, measures: dict[str, str], by: Sequence[str]) -> DataFrame:
    """``roll_up`` with the distinct segments as the bits of ``_BITS``: can be rolled up again."""
    return claims.groupBy("CLM_ID", *by).agg(
        *[F.max(raw).alias(name) for name, raw in measures.items()], F.bit_or(_BITS).alias(_BITS)
    )


def look_up(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """LEFT equi join from an id to its key; unmatched ids get NULL.

    Rows without an id match nothing. A shuffled join would bring all of them to
    one task, so they are dealt out by their claim instead.
    """
    found = keys.withColumnRenamed(column, "_id")
    dealt = F.xxhash64("CLM_ID").cast(rows.schema[column].dataType)
    on = (F.coalesce(column, dealt) == F.col("_id")) & F.col(column).isNotNull()
    return rows.join(found, on, "left").drop("_id")


def look_up_keys(segments: DataFrame, dims: Dimensions) -> DataFrame:
    """The three look-ups."""
    for column, keys in dims.look_ups.items():
        segments = look_up(segments, keys, column)
    return segments


def _fact_rows(claims: DataFrame, claim_type: str, measures: dict[str, str], dims: Dimensions) -> DataFrame:
    if not dims.multiplies_claims and segments_are_bits(claims):
        segments = claims.select("CLM_ID", *ID_COLUMNS, *measures.values(), F.expr("shiftleft(1L, SEGMENT)").alias(_BITS))
        by_id = roll_up_bits(segments, measures, ID_COLUMNS)
        rows = roll_up_bits(look_up_keys(by_id, dims), {name: name for name in measures}, KEY_COLUMNS)
        rows = rows.withColumn("segment_count", F.coalesce(F.bit_count(_BITS), F.lit(0))).drop(_BITS)
    else:
        segments = claims.select("CLM_ID", "SEGMENT", *ID_COLUMNS, *measures.values())
        rows = roll_up(look_up_keys(segments, dims), measures, KEY_COLUMNS)
    if dims.multiplies_claims:
        rows = look_up(rows, dims.all_rows, "patient_key").withColumn("patient_key", F.coalesce("own_key", "patient_key"))
    columns = ["CLM_ID", *KEY_COLUMNS, *measures, "segment_count"]
    values = {name: F.col(name) for name in columns}
    values |= {"claim_id": F.col("CLM_ID"), "claim_type": F.lit(claim_type)}
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields]
    )


def fact_inpatient(inpatient: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows of inpatient claims, without claim_key."""
    return _fact_rows(inpatient, V.INPATIENT, INPATIENT_MEASURES, dims)


def fact_outpatient(outpatient: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows of outpatient claims; stay, DRG, admission, coinsurance and
    physicians stay NULL."""
    return _fact_rows(outpatient, V.OUTPATIENT, OUTPATIENT_MEASURES, dims)


def fact_claims(
    inpatient: DataFrame, outpatient: DataFrame, dims: Dimensions, store: TableStore
) -> DataFrame:
    """Both sides in one fact with its surrogate key."""
    rows = fact_inpatient(inpatient, dims).unionByName(fact_outpatient(outpatient, dims))
    # stored, for the keys sample it before they sort it
    return with_surrogate_key(store.scratch("claim_rows", rows), "claim_key", FACT_ORDER, store)
