"""DuckDB SQL for every registered query, over the given tables.

Written independently of the Spark jobs: segments meet the dimensions before
they are grouped, providers come from a full outer join, keys and ranks from
ROW_NUMBER, labels from VALUES tables. Decimals leave as DOUBLE.
"""

from __future__ import annotations

_FLAGS = [
    "has_alzheimers", "has_heart_failure", "has_chronic_kidney_disease", "has_cancer",
    "has_copd", "has_depression", "has_diabetes", "has_ischemic_heart_disease",
    "has_osteoporosis", "has_rheumatoid_arthritis", "has_stroke",
]  # fixed values, in flag order

_CODES = (
    "['25000', '4280', '4019', '41401', '496', '5859', 'V4581', 'E8889', '1749', "
    "'4599', '2599', '78650', '459', '486', '390']"
)  # fixed values, position = n % 17 + 1

_CHECKS = (
    "(1, 'Negative Claim Amounts', 'FACT_CLAIMS', 'Claims where payment < 0'), "
    "(2, 'Date Integrity (from > thru)', 'FACT_CLAIMS', 'Claims where from_date > thru_date'), "
    "(3, 'Orphaned Patient Keys', 'FACT_CLAIMS', 'Claims with patient_key not in DIM_PATIENTS'), "
    "(4, 'Duplicate Claim IDs', 'FACT_CLAIMS', 'Claims that share a claim_id with another row'), "
    "(5, 'NULL Primary Diagnosis', 'FACT_CLAIMS', 'Claims missing primary_diagnosis_key'), "
    "(6, 'Dates Outside 2008-2010', 'FACT_CLAIMS', 'Claims with from_date outside 20080101-20101231'), "
    "(7, 'Impossible Patient Ages', 'DIM_PATIENTS', 'Patients with age < 0 or age > 120')"
)  # fixed values: position, check_name, table_name, details


def _dx(n: str) -> str:
    return f"{_CODES}[CAST(({n}) % 17 + 1 AS INTEGER)]"


def _pad(n: str, width: int) -> str:
    return f"lpad(CAST({n} AS VARCHAR), {width}, '0')"


def _ymd(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def _half_up(numerator: str, denominator: str) -> str:
    """An integer quotient rounded half away from zero, NULL over zero."""
    return (
        f"CASE WHEN {denominator} <> 0 THEN sign({numerator}) * "
        f"((2 * abs({numerator}) + {denominator}) // (2 * {denominator})) END"
    )


_flag_columns = ",\n  ".join(
    f"CASE WHEN (k + {i}) % 97 <> 0 THEN (k + {13 * i}) % {i + 3} = 0 END AS {name}"
    for i, name in enumerate(_FLAGS)
)
_flag_count = " + ".join(f"(CASE WHEN {name} THEN 1 ELSE 0 END)" for name in _FLAGS)

# name -> (ctes it reads, text)
_CTES: dict[str, tuple[list[str], str]] = {
    "bene": ([], f"""
SELECT 'B' || {_pad('k', 15)} AS patient_id, yr,
  CASE k % 500 WHEN 499 THEN 1885 WHEN 498 THEN 2012 ELSE 1915 + k % 70 END AS birth_year,
  CASE WHEN k % 20 = 0 THEN 2010 END AS death_year,
  CASE WHEN k % 10 <> 9 THEN 1 + k % 2 ELSE 0 END AS sex, k % 6 AS race_code,
  {_pad('1 + c_nationkey', 2)} AS state_code, {_pad('k % 1000', 3)} AS county_code,
  {_flag_columns},
  12 AS hi, 12 AS smi, k % 13 AS hmo,
  CAST(CASE WHEN k % 17 <> 0 THEN a + (CASE WHEN k % 3 = 0 THEN 100 * (yr - 2008) ELSE 0 END) END
    AS DECIMAL(10,2)) AS ip_amount,
  CAST(a + k % 5 AS DECIMAL(10,2)) AS op_amount, CAST(k % 700 AS DECIMAL(10,2)) AS car_amount
FROM (SELECT c_custkey AS k, c_nationkey, CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS a,
        unnest([2008, 2009, 2010]) AS yr FROM customer)"""),
    "patient_rows": (["bene"], f"""
SELECT yr, patient_id, CAST(birth_year AS INTEGER) AS birth_year, CAST(death_year AS INTEGER) AS death_year,
  CAST(2010 - birth_year AS INTEGER) AS age_at_2010,
  coalesce(s.label, 'Unknown') AS gender, coalesce(r.label, 'Unknown') AS race,
  state_code, county_code, death_year IS NOT NULL AS is_deceased, {', '.join(_FLAGS)},
  CAST(hi AS INTEGER) AS total_hi_coverage_months, CAST(smi AS INTEGER) AS total_smi_coverage_months,
  CAST(hmo AS INTEGER) AS total_hmo_coverage_months,
  CAST(ip_amount AS DOUBLE) AS total_inpatient_reimbursement,
  CAST(op_amount AS DOUBLE) AS total_outpatient_reimbursement,
  CAST(car_amount AS DOUBLE) AS total_carrier_reimbursement,
  CAST(ifnull(ip_amount, 0) + ifnull(op_amount, 0) + ifnull(car_amount, 0) AS DOUBLE) AS total_cost,
  CAST({_flag_count} AS INTEGER) AS chronic_condition_count
FROM bene
LEFT JOIN (VALUES (1, 'Male'), (2, 'Female')) s(code, label) ON s.code = sex
LEFT JOIN (VALUES (1, 'White'), (2, 'Black'), (3, 'Other'), (5, 'Hispanic')) r(code, label) ON r.code = race_code"""),
    "patients": (["patient_rows"], """
SELECT row_number() OVER (ORDER BY patient_id, total_inpatient_reimbursement NULLS FIRST) AS patient_key, *
FROM (SELECT DISTINCT * EXCLUDE (yr) FROM patient_rows)"""),
    "seg": ([], f"""
SELECT k AS claim_id, ln AS segment, k % 8 = 0 AS is_ip,
  'B' || {_pad('CASE WHEN k % 211 = 0 THEN 900000000000000 + k ELSE ck END', 15)} AS patient_id,
  CASE WHEN k % 401 <> 0 THEN {_ymd('fd')} END AS from_dt, {_ymd('td')} AS thru_dt, {_ymd('fd')} AS admit_dt,
  CAST(CASE WHEN k % 250 = 0 THEN -price ELSE price END AS DECIMAL(10,2)) AS paid,
  CAST(ln AS DECIMAL(10,2)) AS payer, CAST(l_discount * 100 AS DECIMAL(10,2)) AS deductible,
  CAST(l_tax * 100 AS DECIMAL(10,2)) AS coinsurance,
  CASE WHEN k % 77 <> 0 THEN k % 12 END AS stay,
  CASE WHEN k % 101 <> 0 THEN {_pad('p + (CASE WHEN k % 8 = 0 THEN 0 ELSE 20 END)', 6)} END AS provider_id,
  {_pad('k % 999', 3)} AS drg, {_pad('sk', 10)} AS at_npi, {_pad('sk + ln', 10)} AS op_npi,
  {_dx('k + (CASE WHEN ln = 7 AND k % 90 = 0 THEN 1 ELSE 0 END)')} AS dx1,
  {', '.join(f"{_dx(f'k * {i} + ln')} AS dx{i}" for i in range(2, 11))}
FROM (SELECT l_orderkey AS k, l_linenumber AS ln, l_suppkey AS sk, o_custkey AS ck,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS price, l_discount, l_tax,
        DATE '2008-01-01' + CAST((l_orderkey * 37) % 1100 AS INTEGER) AS fd,
        DATE '2008-01-01' + CAST((l_orderkey * 37) % 1100
          + (CASE WHEN l_orderkey % 333 = 0 THEN -3 ELSE l_orderkey % 12 END) AS INTEGER) AS td,
        CASE WHEN l_linenumber = 7 AND l_orderkey % 50 = 0 THEN l_suppkey % 97
          ELSE (l_orderkey * 31) % 97 END AS p
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""),
    "providers": (["seg"], f"""
SELECT row_number() OVER (ORDER BY provider_id) AS provider_key, provider_id,
  CASE WHEN a IS NULL THEN 'Outpatient Only' WHEN b IS NULL THEN 'Inpatient Only' ELSE 'Both' END AS provider_type,
  CAST(n AS BIGINT) AS total_claims, CAST(ifnull(a, 0) AS BIGINT) AS total_inpatient_claims,
  CAST(ifnull(b, 0) AS BIGINT) AS total_outpatient_claims,
  CAST({_half_up('cents', 'n')} AS DOUBLE) / 100 AS avg_claim_amount,
  CAST(cents AS DOUBLE) / 100 AS total_payment_amount
FROM (SELECT coalesce(x.provider_id, y.provider_id) AS provider_id, a, b, ifnull(a, 0) + ifnull(b, 0) AS n,
        ifnull(x.cents, 0) + ifnull(y.cents, 0) AS cents
      FROM (SELECT provider_id, count(*) AS a, sum(CAST(paid * 100 AS BIGINT)) AS cents
            FROM seg WHERE is_ip AND provider_id IS NOT NULL GROUP BY 1) x
      FULL OUTER JOIN (SELECT provider_id, count(*) AS b, sum(CAST(paid * 100 AS BIGINT)) AS cents
            FROM seg WHERE NOT is_ip AND provider_id IS NOT NULL GROUP BY 1) y
      ON x.provider_id = y.provider_id)"""),
    "codes": (["seg"], """
SELECT DISTINCT code FROM (
  SELECT unnest([dx1, dx2, dx3, dx4, dx5]) AS code FROM seg WHERE is_ip
  UNION ALL SELECT unnest([dx1, dx2, dx3]) FROM seg WHERE NOT is_ip)
WHERE code IS NOT NULL"""),
    "diagnoses": (["codes"], """
SELECT row_number() OVER (ORDER BY code) AS diagnosis_key, code AS icd9_code,
  coalesce(t.label, p.label || code, 'Code: ' || code) AS diagnosis_description,
  coalesce(g.label, q.label, 'Other') AS diagnosis_category
FROM codes
LEFT JOIN (VALUES ('250', 'Diabetes Mellitus'), ('428', 'Heart Failure'), ('401', 'Hypertension'),
  ('414', 'Ischemic Heart Disease'), ('496', 'COPD'), ('585', 'Chronic Kidney Disease')) t(prefix, label)
  ON left(code, 3) = t.prefix
LEFT JOIN (VALUES ('V', 'Supplementary Code V'), ('E', 'External Cause E')) p(prefix, label)
  ON left(code, 1) = p.prefix
LEFT JOIN (VALUES ('390', '459', 'Circulatory System'), ('250', '259', 'Endocrine/Metabolic'),
  ('460', '519', 'Respiratory System'), ('580', '629', 'Genitourinary System'),
  ('140', '239', 'Neoplasms')) g(low, high, label) ON code >= g.low AND code <= g.high
LEFT JOIN (VALUES ('V', 'V Codes'), ('E', 'E Codes')) q(prefix, label) ON left(code, 1) = q.prefix"""),
    "fact_rows": (["seg", "patients", "providers", "diagnoses"], """
SELECT claim_id, CASE WHEN is_ip THEN 'Inpatient' ELSE 'Outpatient' END AS claim_type,
  patient_key, provider_key, diagnosis_key AS primary_diagnosis_key,
  max(from_dt) AS claim_from_date_key, max(thru_dt) AS claim_thru_date_key,
  CASE WHEN is_ip THEN max(admit_dt) END AS admission_date_key,
  max(paid) AS claim_payment_amount, max(payer) AS primary_payer_amount,
  max(deductible) AS deductible_amount, CASE WHEN is_ip THEN max(coinsurance) END AS coinsurance_amount,
  CASE WHEN is_ip THEN CAST(max(stay) AS INTEGER) END AS utilization_days,
  CASE WHEN is_ip THEN max(drg) END AS drg_code, CAST(count(DISTINCT segment) AS INTEGER) AS segment_count,
  CASE WHEN is_ip THEN max(at_npi) END AS attending_physician_npi,
  CASE WHEN is_ip THEN max(op_npi) END AS operating_physician_npi,
  CAST(NULL AS VARCHAR) AS other_physician_npi
FROM seg LEFT JOIN patients USING (patient_id) LEFT JOIN providers USING (provider_id)
LEFT JOIN diagnoses ON dx1 = icd9_code
GROUP BY claim_id, is_ip, patient_key, provider_key, diagnosis_key"""),
    "fact": (["fact_rows"], """
SELECT row_number() OVER (ORDER BY claim_id NULLS FIRST, claim_type, patient_key NULLS FIRST,
  provider_key NULLS FIRST, primary_diagnosis_key NULLS FIRST) AS claim_key, * FROM fact_rows"""),
    "days": ([], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%b') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  strftime(d, '%a') AS day_name, strftime(d, '%a') IN ('Sat', 'Sun') AS is_weekend,
  CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
FROM generate_series(TIMESTAMP '2008-01-01', TIMESTAMP '2010-12-31', INTERVAL 1 DAY) s(d)"""),
    "monthly": (["fact", "days", "diagnoses"], """
SELECT year, month, month_name, CAST(date_trunc('month', full_date) AS DATE) AS month_date,
  claim_type, diagnosis_category,
  count(DISTINCT claim_key) AS claim_count, count(DISTINCT patient_key) AS unique_patients,
  CAST(sum(claim_payment_amount) AS DOUBLE) AS total_paid,
  CAST(sum(claim_payment_amount) AS DOUBLE) / count(claim_payment_amount) AS avg_paid_per_claim,
  avg(utilization_days) AS avg_length_of_stay,
  CAST(sum(utilization_days) AS BIGINT) AS total_utilization_days
FROM fact JOIN days ON claim_from_date_key = date_key
LEFT JOIN diagnoses ON primary_diagnosis_key = diagnosis_key
GROUP BY ALL"""),
    "by_diagnosis": (["fact", "diagnoses"], """
SELECT *, CAST(row_number() OVER (PARTITION BY claim_type ORDER BY total_paid DESC NULLS FIRST, icd9_code)
    AS INTEGER) AS rank_by_cost,
  CAST(row_number() OVER (PARTITION BY claim_type ORDER BY claim_count DESC, icd9_code)
    AS INTEGER) AS rank_by_volume
FROM (SELECT icd9_code, diagnosis_description, diagnosis_category, claim_type,
        count(DISTINCT claim_key) AS claim_count, count(DISTINCT patient_key) AS patient_count,
        CAST(sum(claim_payment_amount) AS DOUBLE) AS total_paid,
        CAST(sum(claim_payment_amount) AS DOUBLE) / count(claim_payment_amount) AS avg_paid_per_claim,
        avg(utilization_days) AS avg_length_of_stay
      FROM fact JOIN diagnoses ON primary_diagnosis_key = diagnosis_key
      GROUP BY ALL)"""),
    "by_provider": (["fact", "providers"], f"""
SELECT provider_id, provider_type, total_claims, unique_patients, total_revenue, avg_claim_amount,
  avg_length_of_stay, CAST({_half_up('10000 * long_stays', 'total_claims')} AS DOUBLE) / 100 AS pct_long_stays,
  CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS FIRST, provider_id) AS INTEGER) AS revenue_rank,
  CAST(row_number() OVER (ORDER BY total_claims DESC, provider_id) AS INTEGER) AS volume_rank
FROM (SELECT p.provider_id, p.provider_type, count(*) AS total_claims,
        count(DISTINCT patient_key) AS unique_patients,
        CAST(sum(claim_payment_amount) AS DOUBLE) AS total_revenue,
        CAST(sum(claim_payment_amount) AS DOUBLE) / count(claim_payment_amount) AS avg_claim_amount,
        avg(utilization_days) AS avg_length_of_stay,
        count(*) FILTER (WHERE utilization_days > 7) AS long_stays
      FROM fact f JOIN providers p ON f.provider_key = p.provider_key
      WHERE claim_type = 'Inpatient' GROUP BY 1, 2)"""),
    "failures": (["fact", "patients"], """
SELECT 1 AS position, count(*) AS failed FROM fact WHERE claim_payment_amount < 0
UNION ALL SELECT 2, count(*) FROM fact WHERE claim_from_date_key > claim_thru_date_key
UNION ALL SELECT 3, count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM patients p WHERE p.patient_key = f.patient_key)
UNION ALL SELECT 4, CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM fact GROUP BY claim_id HAVING count(*) > 1)
UNION ALL SELECT 5, count(*) FROM fact WHERE primary_diagnosis_key IS NULL
UNION ALL SELECT 6, count(*) FROM fact WHERE claim_from_date_key NOT BETWEEN 20080101 AND 20101231
UNION ALL SELECT 7, count(*) FROM patients WHERE age_at_2010 NOT BETWEEN 0 AND 120"""),
    "checks": (["failures", "fact", "patients"], f"""
SELECT CAST(position AS INTEGER) AS position, check_name, table_name,
  CASE failed WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  total AS records_checked, failed AS records_failed,
  CAST({_half_up('10000 * failed', 'total')} AS DOUBLE) / 100 AS failure_rate, details
FROM failures JOIN (VALUES {_CHECKS}) c(position, check_name, table_name, details) USING (position)
JOIN (SELECT 'FACT_CLAIMS' AS table_name, count(*) AS total FROM fact
      UNION ALL SELECT 'DIM_PATIENTS', count(*) FROM patients) USING (table_name)"""),
    "quality_log": ([], f"""
SELECT event_id + 1 AS check_id, check_name, ts AS check_time, table_name,
  CASE WHEN event_id % 5 = 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN event_id % 5 = 0 THEN 1 + event_id % 50 ELSE 0 END AS records_failed, details
FROM events JOIN (VALUES {_CHECKS}) c(position, check_name, table_name, details) ON position = event_id % 7 + 1"""),
    "recent": (["quality_log"], """
SELECT * FROM quality_log
WHERE check_time BETWEEN TIMESTAMP '2024-01-15 11:55:00' AND TIMESTAMP '2024-01-15 12:00:00'"""),
    "runs": ([], """
SELECT s.event_id AS log_id,
  ['load_dim_patients', 'load_fact_claims', 'refresh_marts'][(s.event_id // 2) % 3 + 1] AS job_name,
  s.ts AS start_time, CASE WHEN e.event_id IS NOT NULL THEN s.ts + INTERVAL 90 SECOND END AS end_time,
  CASE WHEN e.event_id IS NULL THEN 'RUNNING' WHEN e.event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN e.event_type <> 'error' THEN e.user_id END AS rows_processed,
  CASE WHEN e.event_type = 'error' THEN 'event reported an error' END AS error_message
FROM events s LEFT JOIN events e ON e.event_id = s.event_id + 1 AND s.event_id % 10 <> 8
WHERE s.event_id % 2 = 0"""),
}


# one row per beneficiary
_LATEST = {"patients": (["patient_rows"], """
SELECT row_number() OVER (ORDER BY patient_id) AS patient_key, * EXCLUDE (yr) FROM (
  SELECT * FROM patient_rows QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY yr DESC) = 1)""")}

_FIT_PEOPLE = "CAST(substr(patient_id, 2) AS BIGINT) % 50 <> 1"
_FIT_CLAIMS = "claim_id % (CASE WHEN is_ip THEN 97 ELSE 89 END) <> 0"
# what is left after the CSV copies were loaded
_FIT = {
    "all_bene": _CTES["bene"],
    "all_seg": _CTES["seg"],
    "bene": (["all_bene"], f"SELECT * FROM all_bene WHERE {_FIT_PEOPLE}"),
    "seg": (["all_seg"], f"SELECT * FROM all_seg WHERE {_FIT_CLAIMS}"),
}


def _sql(body: str, *needs: str, instead: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``WITH`` the named CTEs and all they read, some taken from ``instead``, then ``body``."""
    order: list[str] = []
    known = _CTES | (instead or {})

    def visit(name: str) -> None:
        for parent in known[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({known[name][1]})" for name in order)
    return f"WITH {ctes}\n{body}"


def _all_of(name: str) -> str:
    return _sql(f"SELECT * FROM {name}", name)


def _amounts_as_double(name: str) -> str:
    amounts = ["claim_payment_amount", "primary_payer_amount", "deductible_amount", "coinsurance_amount"]
    casts = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in amounts)
    return f"SELECT * REPLACE ({casts}) FROM {name}"


def _check(position: int) -> str:
    return _sql(f"SELECT * FROM checks WHERE position = {position}", "checks")


def _counts(tables: dict[str, str], *needs: str, instead=None) -> str:
    parts = [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in tables.items()]
    return _sql(" UNION ALL ".join(parts) + " ORDER BY table_name", *needs, instead=instead)


_RAW_FLAGS = [
    "SP_ALZHDMTA", "SP_CHF", "SP_CHRNKIDN", "SP_CNCR", "SP_COPD", "SP_DEPRESSN", "SP_DIABETES",
    "SP_ISCHMCHT", "SP_OSTEOPRS", "SP_RA_OA", "SP_STRKETIA",
]  # fixed values, in flag order


def _csv_beneficiary() -> str:
    k = "CAST(substr(patient_id, 2) AS BIGINT)"
    day = f"(1 + {k} % 12) * 100 + 1 + {k} % 28"
    flags = ", ".join(
        f"CAST(CASE WHEN {ours} THEN 1 WHEN NOT {ours} THEN 2 END AS INTEGER) AS {raw}"
        for raw, ours in zip(_RAW_FLAGS, _FLAGS)
    )
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS {a}_{b}" for a in ("BENRES", "PPPYMT") for b in ("IP", "OP", "CAR"))
    return f"""SELECT patient_id AS DESYNPUF_ID, CAST(birth_year * 10000 + {day} AS INTEGER) AS BENE_BIRTH_DT,
    CAST(death_year * 10000 + {day} AS INTEGER) AS BENE_DEATH_DT, CAST(sex AS INTEGER) AS BENE_SEX_IDENT_CD,
    CAST(race_code AS INTEGER) AS BENE_RACE_CD, CASE WHEN {k} % 15 = 0 THEN 'Y' ELSE '0' END AS BENE_ESRD_IND,
    state_code AS SP_STATE_CODE, county_code AS BENE_COUNTY_CD, CAST(hi AS INTEGER) AS BENE_HI_CVRAGE_TOT_MONS,
    CAST(smi AS INTEGER) AS BENE_SMI_CVRAGE_TOT_MONS, CAST(hmo AS INTEGER) AS BENE_HMO_CVRAGE_TOT_MONS, {flags},
    CAST(ip_amount AS DOUBLE) AS MEDREIMB_IP, CAST(op_amount AS DOUBLE) AS MEDREIMB_OP,
    CAST(car_amount AS DOUBLE) AS MEDREIMB_CAR, {zeros}, CAST(yr AS INTEGER) AS src_year
    FROM bene WHERE {k} % 50 <> 1"""


def _csv_claims(inpatient: bool) -> str:
    codes = ", ".join(f"dx{i} AS ICD9_DGNS_CD_{i}" for i in range(1, 11))
    procedures = ", ".join(f"CAST(NULL AS VARCHAR) AS ICD9_PRCDR_CD_{i}" for i in range(1, 7))
    own = (
        """admit_dt AS CLM_ADMSN_DT, thru_dt AS NCH_BENE_DSCHRG_DT,
        CAST(deductible AS DOUBLE) AS NCH_BENE_IP_DDCTBL_AMT,
        CAST(coinsurance AS DOUBLE) AS NCH_BENE_PTA_COINSRNC_LBLTY_AM,
        CAST(stay AS INTEGER) AS CLM_UTLZTN_DAY_CNT, drg AS CLM_DRG_CD,"""
        if inpatient
        else """CAST(deductible AS DOUBLE) AS NCH_BENE_PTB_DDCTBL_AMT,
        CAST(coinsurance AS DOUBLE) AS NCH_BENE_PTB_COINSRNC_AMT,"""
    )
    fit = "is_ip AND claim_id % 97 <> 0" if inpatient else "NOT is_ip AND claim_id % 89 <> 0"
    return f"""SELECT patient_id AS DESYNPUF_ID, claim_id AS CLM_ID, segment AS SEGMENT, from_dt AS CLM_FROM_DT,
    thru_dt AS CLM_THRU_DT, CAST(paid AS DOUBLE) AS CLM_PMT_AMT, CAST(payer AS DOUBLE) AS NCH_PRMRY_PYR_CLM_PD_AMT,
    {own} provider_id AS PRVDR_NUM, at_npi AS AT_PHYSN_NPI, op_npi AS OP_PHYSN_NPI,
    CAST(NULL AS VARCHAR) AS OT_PHYSN_NPI, {codes}, {procedures} FROM seg WHERE {fit}"""


_CATEGORIES = "diagnosis_category IN ('Circulatory System', 'Endocrine/Metabolic')"


def _kpi(some: str = "TRUE") -> str:
    return _sql(
        f"""SELECT CAST(sum(claim_payment_amount) AS DOUBLE) AS total_paid, count(*) AS claim_count,
        (SELECT CAST(sum(unique_patients) AS BIGINT) FROM monthly WHERE {some}) AS unique_patients_sum,
        CAST(sum(claim_payment_amount) AS DOUBLE) / count(*) AS avg_paid_per_claim,
        (SELECT CAST(sum(CAST(avg_length_of_stay AS DECIMAL(18,6))) AS DOUBLE) / count(avg_length_of_stay)
          FROM monthly WHERE {some}) AS avg_length_of_stay_mean,
        count(DISTINCT patient_key) AS unique_patients_exact, avg(utilization_days) AS avg_length_of_stay_exact
        FROM fact JOIN days ON claim_from_date_key = date_key
        LEFT JOIN diagnoses ON primary_diagnosis_key = diagnosis_key WHERE {some}""",
        "fact", "days", "diagnoses", "monthly",
    )


def _trend(some: str = "TRUE") -> str:
    return _sql(
        f"""SELECT CAST(date_trunc('month', full_date) AS DATE) AS month_date,
        CAST(sum(claim_payment_amount) AS DOUBLE) AS total_paid, count(*) AS claim_count,
        CAST(sum(utilization_days) AS BIGINT) AS total_utilization_days,
        avg(utilization_days) AS avg_length_of_stay_exact,
        CAST(sum(utilization_days) AS DOUBLE) / count(*) AS stay_days_per_claim
        FROM fact JOIN days ON claim_from_date_key = date_key
        LEFT JOIN diagnoses ON primary_diagnosis_key = diagnosis_key
        WHERE claim_type = 'Inpatient' AND {some} GROUP BY 1 ORDER BY 1""",
        "fact", "days", "diagnoses",
    )


_OUTPATIENT_ROWS = "(SELECT count(*) FROM fact WHERE claim_type = 'Outpatient')"
_PATIENT_ROWS = "(SELECT count(*) FROM patients)"


def _job_rows(runs: int, first: str) -> str:
    """A report of pipeline runs; ``first`` are the values of the patient job."""
    return _sql(
        f"""SELECT job_name, status, CAST(rows_processed AS BIGINT) AS rows_processed, CAST(7 AS BIGINT) AS duration_sec,
        CAST(error_message AS VARCHAR) AS error_message
        FROM range({runs}) run(n), (VALUES (1, 'sp_load_dim_patients', {first}),
          (2, 'sp_load_fact_claims', 'SUCCESS', {_OUTPATIENT_ROWS}, NULL), (3, 'sp_refresh_marts', 'SUCCESS', 3, NULL)
        ) job(place, job_name, status, rows_processed, error_message) ORDER BY n DESC, place DESC""",
        "fact", "patients", instead=_FIT,
    )


ORACLE_SQL: dict[str, str] = {
    "csv_beneficiary": _sql(_csv_beneficiary(), "bene"),
    "csv_inpatient": _sql(_csv_claims(inpatient=True), "seg"),
    "csv_outpatient": _sql(_csv_claims(inpatient=False), "seg"),
    "csv_rejected": _sql(
        f"""SELECT 'BENEFICIARY_SUMMARY' AS table_name, patient_id AS row_id, CAST(yr AS VARCHAR) AS part_id,
          'BENE_COUNTY_CD' AS faulty_column, '1000' AS faulty_text FROM bene WHERE NOT ({_FIT_PEOPLE})
        UNION ALL SELECT CASE WHEN is_ip THEN 'INPATIENT_CLAIMS' ELSE 'OUTPATIENT_CLAIMS' END,
          CAST(claim_id AS VARCHAR), CAST(segment AS VARCHAR), CASE WHEN is_ip THEN 'CLM_PMT_AMT' ELSE 'PRVDR_NUM' END,
          CASE WHEN is_ip THEN 'n/a' ELSE '0000000' END FROM seg WHERE NOT ({_FIT_CLAIMS})""",
        "bene", "seg",
    ),
    "csv_load_result": _sql(
        f"""SELECT table_name, src_year, count(*) AS rows_read, count(*) FILTER (WHERE fit) AS rows_loaded,
        count(*) FILTER (WHERE NOT fit) AS rows_rejected, max(CASE WHEN NOT fit THEN reason END) AS main_reason
        FROM (
          SELECT 'BENEFICIARY_SUMMARY' AS table_name, CAST(yr AS INTEGER) AS src_year, {_FIT_PEOPLE} AS fit, 'BENE_COUNTY_CD' AS reason FROM bene
          UNION ALL SELECT CASE WHEN is_ip THEN 'INPATIENT_CLAIMS' ELSE 'OUTPATIENT_CLAIMS' END, NULL, {_FIT_CLAIMS},
            CASE WHEN is_ip THEN 'CLM_PMT_AMT' ELSE 'PRVDR_NUM' END FROM seg
        ) GROUP BY table_name, src_year""",
        "bene", "seg",
    ),
    "dim_date": _sql(
        """SELECT days.*, coalesce(n, 0) AS claims_started FROM days LEFT JOIN
        (SELECT claim_from_date_key AS k, count(*) AS n FROM fact GROUP BY 1) ON k = date_key""",
        "days", "fact",
    ),
    "dim_patients": _all_of("patients"),
    "dim_patients_latest": _sql("SELECT * FROM patients", "patients", instead=_LATEST),
    "dim_providers": _all_of("providers"),
    "dim_diagnoses": _all_of("diagnoses"),
    "diagnosis_codes": _sql("SELECT code AS icd9_code FROM codes", "codes"),
    "fact_inpatient": _sql(_amounts_as_double("fact_rows") + " WHERE claim_type = 'Inpatient'", "fact_rows"),
    "fact_outpatient": _sql(_amounts_as_double("fact_rows") + " WHERE claim_type = 'Outpatient'", "fact_rows"),
    "fact_claims": _sql(_amounts_as_double("fact"), "fact"),
    "fact_claims_latest": _sql(_amounts_as_double("fact"), "fact", instead=_LATEST),
    "mart_monthly": _all_of("monthly"),
    "mart_monthly_latest": _sql("SELECT * FROM monthly", "monthly", instead=_LATEST),
    "mart_monthly_etl": _sql("SELECT * EXCLUDE (total_utilization_days) FROM monthly", "monthly"),
    "mart_diagnosis": _all_of("by_diagnosis"),
    "mart_diagnosis_etl": _sql("SELECT * EXCLUDE (rank_by_cost, rank_by_volume) FROM by_diagnosis", "by_diagnosis"),
    "mart_provider": _all_of("by_provider"),
    "mart_provider_etl": _sql("SELECT * EXCLUDE (revenue_rank, volume_rank) FROM by_provider", "by_provider"),
    "dq_negative_amounts": _check(1),
    "dq_date_integrity": _check(2),
    "dq_orphan_patients": _check(3),
    "dq_duplicate_claims": _check(4),
    "dq_null_diagnosis": _check(5),
    "dq_date_range": _check(6),
    "dq_impossible_ages": _check(7),
    "dq_all": _all_of("checks"),
    "dq_summary": _sql(
        """SELECT passed, total, passed || ' / ' || total || ' checks passed' AS summary
        FROM (SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) AS total FROM recent)""",
        "recent",
    ),
    "dq_latest": _sql(
        """SELECT check_name, table_name, status, CAST(records_failed AS BIGINT) AS records_failed,
        CAST(records_failed AS DOUBLE) / 10 AS failure_rate, details FROM recent ORDER BY check_id""",
        "recent",
    ),
    "dq_history": _sql(
        """SELECT check_name, count(*) AS total_runs, count(*) FILTER (WHERE status = 'PASS') AS times_passed,
        count(*) FILTER (WHERE status = 'FAIL') AS times_failed, max(records_failed) AS max_failures_seen
        FROM quality_log GROUP BY check_name""",
        "quality_log",
    ),
    "etl_log_current": _all_of("runs"),
    "etl_log_report": _sql(
        """SELECT job_name, status, rows_processed, date_diff('second', start_time, end_time) AS duration_sec,
        error_message FROM runs ORDER BY start_time DESC""",
        "runs",
    ),
    "job_pipeline_log": _job_rows(2, f"'SUCCESS', {_PATIENT_ROWS}, NULL"),
    "job_failed_log": _job_rows(1, "'FAILED', NULL, 'dedup is ''literal'' or ''latest'', not ''none'''"),
    "job_table_counts": _counts(
        {"BENEFICIARY_SUMMARY": "bene", "INPATIENT_CLAIMS": "seg WHERE is_ip",
         "OUTPATIENT_CLAIMS": "seg WHERE NOT is_ip",
         "BENEFICIARY_SUMMARY_REJECTED": f"all_bene WHERE NOT ({_FIT_PEOPLE})",
         "INPATIENT_CLAIMS_REJECTED": f"all_seg WHERE is_ip AND NOT ({_FIT_CLAIMS})",
         "OUTPATIENT_CLAIMS_REJECTED": f"all_seg WHERE NOT is_ip AND NOT ({_FIT_CLAIMS})",
         "DIM_DATE": "days", "DIM_PATIENTS": "patients", "DIM_PROVIDERS": "providers",
         "DIM_DIAGNOSES": "diagnoses", "FACT_CLAIMS": "fact",
         "MART_MONTHLY_CLAIMS_SUMMARY": "monthly", "MART_DIAGNOSIS_SUMMARY": "by_diagnosis",
         "MART_PROVIDER_PERFORMANCE": "by_provider"},
        "days", "monthly", "by_diagnosis", "by_provider", instead=_FIT,
    ),
    "job_quality_log": _sql(
        """SELECT position + 7 * n AS check_id, check_name,
          TIMESTAMP '2024-01-01 08:00:07' + n * INTERVAL 14 SECOND AS check_time, table_name, status,
          records_checked, records_failed, failure_rate, details,
          (n + 1) * passed || ' / ' || (n + 1) * 7 || ' checks passed' AS answer
        FROM checks, range(2) run(n), (SELECT count(*) AS passed FROM checks WHERE status = 'PASS')""",
        "checks", instead=_FIT,
    ),
    "row_counts_raw": _counts(
        {"BENEFICIARY_SUMMARY": "bene", "INPATIENT_CLAIMS": "seg WHERE is_ip",
         "OUTPATIENT_CLAIMS": "seg WHERE NOT is_ip"},
        "bene", "seg",
    ),
    "row_counts_star": _counts(
        {"DIM_DATE": "days", "DIM_PATIENTS": "patients", "DIM_PROVIDERS": "providers",
         "DIM_DIAGNOSES": "diagnoses", "FACT_CLAIMS": "fact"},
        "days", "patients", "providers", "diagnoses", "fact",
    ),
    "row_counts_marts": _counts(
        {"MART_MONTHLY_CLAIMS_SUMMARY": "monthly", "MART_DIAGNOSIS_SUMMARY": "by_diagnosis",
         "MART_PROVIDER_PERFORMANCE": "by_provider"},
        "monthly", "by_diagnosis", "by_provider",
    ),
    "kpi_cards": _kpi(),
    "kpi_cards_by_category": _kpi(_CATEGORIES),
    "top_diagnoses_cost": _sql("SELECT * FROM by_diagnosis WHERE rank_by_cost <= 10", "by_diagnosis"),
    "top_diagnoses_volume": _sql(
        "SELECT * FROM by_diagnosis WHERE rank_by_volume <= 10 AND claim_type = 'Inpatient'", "by_diagnosis"
    ),
    "diagnoses_by_stay": _sql(
        """SELECT icd9_code, diagnosis_description, diagnosis_category, claim_type, avg_length_of_stay
        FROM by_diagnosis ORDER BY avg_length_of_stay DESC NULLS LAST, icd9_code, claim_type""",
        "by_diagnosis",
    ),
    "cost_vs_utilization": _sql(
        """SELECT icd9_code, diagnosis_description, diagnosis_category, claim_type, claim_count, total_paid,
        avg_paid_per_claim, avg_length_of_stay FROM by_diagnosis""",
        "by_diagnosis",
    ),
    "monthly_trend_inpatient": _trend(),
    "monthly_trend_by_category": _trend(_CATEGORIES),
    "category_drilldown": _sql(
        "SELECT * FROM monthly WHERE diagnosis_category IN ('Circulatory System', 'Endocrine/Metabolic')",
        "monthly",
    ),
}
