"""Values that results depend on: names, labels, code ranges and texts.

Fixed values, stated as they must appear in tables and logs. No logic here.
"""

from datetime import date

# --- fixed values: calendar ------------------------------------------------
CALENDAR_START = date(2008, 1, 1)
CALENDAR_END = date(2010, 12, 31)
AGE_REFERENCE_YEAR = 2010
FIRST_CLAIM_DAY = 20080101
LAST_CLAIM_DAY = 20101231

# --- fixed values: demographic codes ---------------------------------------
SEX_LABELS = {1: "Male", 2: "Female"}
RACE_LABELS = {1: "White", 2: "Black", 3: "Other", 5: "Hispanic"}
UNKNOWN_LABEL = "Unknown"

# --- fixed values: condition flags, raw column -> dimension column ---------
CONDITION_FLAGS = {
    "SP_ALZHDMTA": "has_alzheimers",
    "SP_CHF": "has_heart_failure",
    "SP_CHRNKIDN": "has_chronic_kidney_disease",
    "SP_CNCR": "has_cancer",
    "SP_COPD": "has_copd",
    "SP_DEPRESSN": "has_depression",
    "SP_DIABETES": "has_diabetes",
    "SP_ISCHMCHT": "has_ischemic_heart_disease",
    "SP_OSTEOPRS": "has_osteoporosis",
    "SP_RA_OA": "has_rheumatoid_arthritis",
    "SP_STRKETIA": "has_stroke",
}

# --- fixed values: claim and provider types --------------------------------
INPATIENT = "Inpatient"
OUTPATIENT = "Outpatient"
PROVIDER_BOTH = "Both"
PROVIDER_INPATIENT_ONLY = "Inpatient Only"
PROVIDER_OUTPATIENT_ONLY = "Outpatient Only"
LONG_STAY_DAYS = 7

# --- fixed values: ICD-9 texts by code prefix, first match wins ------------
DIAGNOSIS_TEXT_BY_PREFIX = [
    ("250", "Diabetes Mellitus"),
    ("428", "Heart Failure"),
    ("401", "Hypertension"),
    ("414", "Ischemic Heart Disease"),
    ("496", "COPD"),
    ("585", "Chronic Kidney Disease"),
]
# prefix of the code -> text put in front of the whole code
DIAGNOSIS_TEXT_BEFORE_CODE = [
    ("V", "Supplementary Code V"),
    ("E", "External Cause E"),
]
DIAGNOSIS_TEXT_OTHERWISE = "Code: "

# --- fixed values: ICD-9 categories by string range, both ends included ----
DIAGNOSIS_CATEGORY_BY_RANGE = [
    ("390", "459", "Circulatory System"),
    ("250", "259", "Endocrine/Metabolic"),
    ("460", "519", "Respiratory System"),
    ("580", "629", "Genitourinary System"),
    ("140", "239", "Neoplasms"),
]
DIAGNOSIS_CATEGORY_BY_PREFIX = [
    ("V", "V Codes"),
    ("E", "E Codes"),
]
DIAGNOSIS_CATEGORY_OTHERWISE = "Other"

# --- fixed values: which code columns feed the diagnosis dimension ---------
INPATIENT_CODE_COLUMNS = [f"ICD9_DGNS_CD_{i}" for i in range(1, 6)]
OUTPATIENT_CODE_COLUMNS = [f"ICD9_DGNS_CD_{i}" for i in range(1, 4)]

# --- fixed values: quality checks, in logged order -------------------------
# (check_name, table_name, details)
QUALITY_CHECKS = [
    ("Negative Claim Amounts", "FACT_CLAIMS", "Claims where payment < 0"),
    ("Date Integrity (from > thru)", "FACT_CLAIMS", "Claims where from_date > thru_date"),
    ("Orphaned Patient Keys", "FACT_CLAIMS", "Claims with patient_key not in DIM_PATIENTS"),
    ("Duplicate Claim IDs", "FACT_CLAIMS", "Claims that share a claim_id with another row"),
    ("NULL Primary Diagnosis", "FACT_CLAIMS", "Claims missing primary_diagnosis_key"),
    ("Dates Outside 2008-2010", "FACT_CLAIMS", "Claims with from_date outside 20080101-20101231"),
    ("Impossible Patient Ages", "DIM_PATIENTS", "Patients with age < 0 or age > 120"),
]
MAX_AGE = 120
REPORT_WINDOW_MINUTES = 5

# --- fixed values: job names, statuses and return texts --------------------
JOB_PATIENTS = "sp_load_dim_patients"
JOB_FACT = "sp_load_fact_claims"
JOB_MARTS = "sp_refresh_marts"
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
PASS = "PASS"
FAIL = "FAIL"
TEXT_PATIENTS_LOADED = "SUCCESS: {rows} patients loaded"
TEXT_FACT_LOADED = "SUCCESS: fact table reloaded"
TEXT_MARTS_REFRESHED = "SUCCESS: all marts refreshed"
TEXT_PIPELINE_DONE = "Full ETL pipeline completed successfully"
TEXT_JOB_FAILED = "FAILED: {error}"
TEXT_PIPELINE_FAILED = "Pipeline FAILED: {error}"
TEXT_CHECKS_PASSED = "{passed} / {total} checks passed"
TEXT_CHECKS_FAILED = "QUALITY CHECK FAILED: {error}"
