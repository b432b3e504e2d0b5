"""Declared schemas of the raw tables and the two logs.

Declared VARCHAR lengths ride along as field metadata (``max_length``) so the
CSV load can reject over-long values; Spark itself does not enforce them.
"""

from pyspark.sql import types as T

AMOUNT = T.DecimalType(10, 2)
# Sums of AMOUNT keep Spark's own sum type: (10,2) would overflow at scale.
TOTAL = T.DecimalType(20, 2)


def _text(name: str, length: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {"max_length": length})


def _int(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType())


def _amount(name: str) -> T.StructField:
    return T.StructField(name, AMOUNT)


def _codes(kind: str, count: int) -> list[T.StructField]:
    return [_text(f"ICD9_{kind}_CD_{i}", 5) for i in range(1, count + 1)]


BENEFICIARY = T.StructType(
    [
        _text("DESYNPUF_ID", 16),
        _int("BENE_BIRTH_DT"),
        _int("BENE_DEATH_DT"),
        _int("BENE_SEX_IDENT_CD"),
        _int("BENE_RACE_CD"),
        _text("BENE_ESRD_IND", 1),
        _text("SP_STATE_CODE", 2),
        _text("BENE_COUNTY_CD", 3),
        _int("BENE_HI_CVRAGE_TOT_MONS"),
        _int("BENE_SMI_CVRAGE_TOT_MONS"),
        _int("BENE_HMO_CVRAGE_TOT_MONS"),
        _int("SP_ALZHDMTA"),
        _int("SP_CHF"),
        _int("SP_CHRNKIDN"),
        _int("SP_CNCR"),
        _int("SP_COPD"),
        _int("SP_DEPRESSN"),
        _int("SP_DIABETES"),
        _int("SP_ISCHMCHT"),
        _int("SP_OSTEOPRS"),
        _int("SP_RA_OA"),
        _int("SP_STRKETIA"),
        _amount("MEDREIMB_IP"),
        _amount("BENRES_IP"),
        _amount("PPPYMT_IP"),
        _amount("MEDREIMB_OP"),
        _amount("BENRES_OP"),
        _amount("PPPYMT_OP"),
        _amount("MEDREIMB_CAR"),
        _amount("BENRES_CAR"),
        _amount("PPPYMT_CAR"),
    ]
)

_CLAIM_HEAD = [
    _text("DESYNPUF_ID", 16),
    T.StructField("CLM_ID", T.LongType()),
    _int("SEGMENT"),
    _int("CLM_FROM_DT"),
    _int("CLM_THRU_DT"),
]
_PHYSICIANS = [_text(f"{role}_PHYSN_NPI", 10) for role in ("AT", "OP", "OT")]
_CLAIM_CODES = _codes("DGNS", 10) + _codes("PRCDR", 6)

INPATIENT = T.StructType(
    _CLAIM_HEAD
    + [
        _int("CLM_ADMSN_DT"),
        _int("NCH_BENE_DSCHRG_DT"),
        _amount("CLM_PMT_AMT"),
        _amount("NCH_PRMRY_PYR_CLM_PD_AMT"),
        _amount("NCH_BENE_IP_DDCTBL_AMT"),
        _amount("NCH_BENE_PTA_COINSRNC_LBLTY_AM"),
        _int("CLM_UTLZTN_DAY_CNT"),
        _text("PRVDR_NUM", 6),
        _text("CLM_DRG_CD", 3),
    ]
    + _PHYSICIANS
    + _CLAIM_CODES
)

OUTPATIENT = T.StructType(
    _CLAIM_HEAD
    + [
        _amount("CLM_PMT_AMT"),
        _amount("NCH_PRMRY_PYR_CLM_PD_AMT"),
        _amount("NCH_BENE_PTB_DDCTBL_AMT"),
        _amount("NCH_BENE_PTB_COINSRNC_AMT"),
        _text("PRVDR_NUM", 6),
    ]
    + _PHYSICIANS
    + _CLAIM_CODES
)

# raw table -> its declared columns
RAW = {"BENEFICIARY_SUMMARY": BENEFICIARY, "INPATIENT_CLAIMS": INPATIENT, "OUTPATIENT_CLAIMS": OUTPATIENT}

ETL_JOB_LOG = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

DATA_QUALITY_LOG = T.StructType(
    [
        T.StructField("check_id", T.LongType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("check_time", T.TimestampNTZType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_checked", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("failure_rate", T.DecimalType(5, 2)),
        T.StructField("details", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
