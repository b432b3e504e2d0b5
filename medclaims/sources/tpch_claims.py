"""Claims-shaped raw tables derived from customer, orders and lineitem.

The mapping is the one in FIXTURES.md part 2: integer arithmetic and CASE only,
so that every engine gets the same values.
"""

import math

from pyspark.sql import DataFrame, SparkSession

from medclaims import schemas
from medclaims.fixed_values import CONDITION_FLAGS

# customers in one task; each gives three wide rows
CUSTOMERS_PER_TASK = 12_500

CODES = [
    "25000", "4280", "4019", "41401", "496", "5859", "V4581", "E8889", "1749",
    "4599", "2599", "78650", "459", "486", "390",
]  # fixed values: position = n % 17; 15 and 16 mean no code


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(n: str) -> str:
    values = ", ".join(f"'{code}'" for code in CODES)
    return f"get(array({values}), cast(({n}) % 17 as int))"


def _pad(n: str, width: int) -> str:
    return f"lpad(cast({n} as string), {width}, '0')"


def _ymd(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as int)"


def _typed(df: DataFrame, schema, expressions: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    columns = [
        f"cast({expressions[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields
    ]
    return df.selectExpr(*columns, *extra)


def beneficiary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three yearly rows per customer, with their year in ``src_year``.

    A customer file is small and often a single split, but its rows grow wide here, so
    the customers are dealt out first, as many to a task at any size.
    """
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "c_nationkey", "cast(abs(c_acctbal) as decimal(10,2)) as a"
    )
    tasks = max(1, math.ceil(customers.count() / CUSTOMERS_PER_TASK))
    years = customers.repartition(tasks, *customers.columns).selectExpr("*", "explode(array(2008, 2009, 2010)) as yr")
    month_day = "(1 + k % 12) * 100 + 1 + k % 28"
    zero = "0"
    flags = {
        name: f"case when (k + {i}) % 97 = 0 then null when (k + {13 * i}) % {i + 3} = 0 then 1 else 2 end"
        for i, name in enumerate(CONDITION_FLAGS)
    }
    return _typed(
        years,
        schemas.BENEFICIARY,
        {
            "DESYNPUF_ID": f"concat('B', {_pad('k', 15)})",
            "BENE_BIRTH_DT": "(case when k % 500 = 499 then 1885 when k % 500 = 498 then 2012 "
            f"else 1915 + k % 70 end) * 10000 + {month_day}",
            "BENE_DEATH_DT": f"case when k % 20 = 0 then 20100000 + {month_day} end",
            "BENE_SEX_IDENT_CD": "case when k % 10 = 9 then 0 else 1 + k % 2 end",
            "BENE_RACE_CD": "k % 6",
            "BENE_ESRD_IND": "case when k % 15 = 0 then 'Y' else '0' end",
            "SP_STATE_CODE": _pad("1 + c_nationkey", 2),
            "BENE_COUNTY_CD": _pad("k % 1000", 3),
            "BENE_HI_CVRAGE_TOT_MONS": "12",
            "BENE_SMI_CVRAGE_TOT_MONS": "12",
            "BENE_HMO_CVRAGE_TOT_MONS": "k % 13",
            **flags,
            "MEDREIMB_IP": "case when k % 17 = 0 then null "
            "when k % 3 = 0 then a + 100 * (yr - 2008) else a end",
            "MEDREIMB_OP": "a + k % 5",
            "MEDREIMB_CAR": "k % 700",
            "BENRES_IP": zero, "PPPYMT_IP": zero,
            "BENRES_OP": zero, "PPPYMT_OP": zero,
            "BENRES_CAR": zero, "PPPYMT_CAR": zero,
        },
        ("yr as src_year",),
    )


def _segments(spark: SparkSession, sf_dir: str, inpatient: bool) -> DataFrame:
    """Line items with their order's customer; orders divisible by 8 are inpatient.

    Both sides grow with the data, so the join is a sort-merge join at any size;
    its shuffle also spreads the wide projection that follows over all tasks.
    """
    side = "= 0" if inpatient else "<> 0"
    orders = _table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as ck")
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "l_linenumber as ln", "l_suppkey as sk",
        "l_extendedprice", "l_discount", "l_tax",
    )
    joined = lines.where(f"k % 8 {side}").join(orders.hint("merge"), "k")
    return joined.selectExpr(
        "*",
        "date_add(date'2008-01-01', cast((k * 37) % 1100 as int)) as fd",
        "date_add(date'2008-01-01', cast((k * 37) % 1100 "
        "+ case when k % 333 = 0 then -3 else k % 12 end as int)) as td",
        "case when ln = 7 and k % 50 = 0 then sk % 97 else (k * 31) % 97 end as p",
    )


def _shared_claim_columns(provider_offset: int) -> dict[str, str]:
    other_codes = {f"ICD9_DGNS_CD_{i}": _code(f"k * {i} + ln") for i in range(2, 11)}
    return {
        "DESYNPUF_ID": f"concat('B', {_pad('case when k % 211 = 0 then 900000000000000 + k else ck end', 15)})",
        "CLM_ID": "k",
        "SEGMENT": "ln",
        "CLM_FROM_DT": f"case when k % 401 = 0 then null else {_ymd('fd')} end",
        "CLM_THRU_DT": _ymd("td"),
        "CLM_PMT_AMT": "cast(l_extendedprice as decimal(10,2)) * case when k % 250 = 0 then -1 else 1 end",
        "NCH_PRMRY_PYR_CLM_PD_AMT": "ln",
        "PRVDR_NUM": f"case when k % 101 = 0 then null else {_pad(f'p + {provider_offset}', 6)} end",
        "AT_PHYSN_NPI": _pad("sk", 10),
        "OP_PHYSN_NPI": _pad("sk + ln", 10),
        "OT_PHYSN_NPI": "null",
        "ICD9_DGNS_CD_1": _code("k + case when ln = 7 and k % 90 = 0 then 1 else 0 end"),
        **other_codes,
        **{f"ICD9_PRCDR_CD_{i}": "null" for i in range(1, 7)},
    }


def inpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(
        _segments(spark, sf_dir, inpatient=True),
        schemas.INPATIENT,
        {
            **_shared_claim_columns(provider_offset=0),
            "CLM_ADMSN_DT": _ymd("fd"),
            "NCH_BENE_DSCHRG_DT": _ymd("td"),
            "NCH_BENE_IP_DDCTBL_AMT": "l_discount * 100",
            "NCH_BENE_PTA_COINSRNC_LBLTY_AM": "l_tax * 100",
            "CLM_UTLZTN_DAY_CNT": "case when k % 77 = 0 then null else k % 12 end",
            "CLM_DRG_CD": _pad("k % 999", 3),
        },
    )


def outpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(
        _segments(spark, sf_dir, inpatient=False),
        schemas.OUTPATIENT,
        {
            **_shared_claim_columns(provider_offset=20),
            "NCH_BENE_PTB_DDCTBL_AMT": "l_discount * 100",
            "NCH_BENE_PTB_COINSRNC_AMT": "l_tax * 100",
        },
    )
