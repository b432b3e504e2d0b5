from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from medclaims.functions import calendar as cal
from medclaims.functions import labels, measures
from medclaims.operators.dims import dim_date


@pytest.mark.parametrize(
    "code, text, category",
    [
        ("25000", "Diabetes Mellitus", "Endocrine/Metabolic"),
        ("4280", "Heart Failure", "Circulatory System"),
        ("4019", "Hypertension", "Circulatory System"),
        ("41401", "Ischemic Heart Disease", "Circulatory System"),
        ("496", "COPD", "Respiratory System"),
        ("5859", "Chronic Kidney Disease", "Genitourinary System"),
        ("1749", "Code: 1749", "Neoplasms"),
        # the ranges compare as strings: longer codes under the upper bound fall out
        ("459", "Code: 459", "Circulatory System"),
        ("4599", "Code: 4599", "Other"),
        ("259", "Code: 259", "Endocrine/Metabolic"),
        ("2599", "Code: 2599", "Other"),
        ("390", "Code: 390", "Circulatory System"),
        ("5199", "Code: 5199", "Other"),
        ("629", "Code: 629", "Genitourinary System"),
        ("140", "Code: 140", "Neoplasms"),
        ("78650", "Code: 78650", "Other"),
        # the letter is doubled
        ("V4581", "Supplementary Code VV4581", "V Codes"),
        ("E8889", "External Cause EE8889", "E Codes"),
        ("v12", "Code: v12", "Other"),
        ("", "Code: ", "Other"),
    ],
)
def test_diagnosis_labels(spark, code, text, category):
    row = spark.createDataFrame([(code,)], "c string").select(
        labels.diagnosis_text("c"), labels.diagnosis_category("c")
    ).first()
    assert tuple(row) == (text, category)


def test_code_labels_default_to_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (0,), (None,)], "c int")
    got = [r[0] for r in df.select(labels.label("c", {1: "Male", 2: "Female"})).collect()]
    assert got == ["Male", "Female", "Unknown", "Unknown"]


def test_year_of_key_and_null(spark):
    df = spark.createDataFrame([(19231105,), (20101231,), (None,)], "d int")
    assert [r[0] for r in df.select(cal.year_of_key("d")).collect()] == [1923, 2010, None]


def test_seconds_between_counts_boundaries(spark):
    rows = [
        (datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)),
        (datetime(2024, 1, 1, 0, 0, 0, 100000), datetime(2024, 1, 1, 0, 0, 0, 900000)),
        (datetime(2024, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(cal.seconds_between("a", "b")).collect()] == [1, 0, None]


def test_flag_count_and_null_safe_sum(spark):
    df = spark.createDataFrame([(1, None, 2), (None, None, None), (1, 1, 1)], "a int, b int, c int")
    got = df.select(measures.flag_count("abc"), measures.null_safe_sum("abc")).collect()
    assert [tuple(r) for r in got] == [(1, 3), (0, 0), (3, 3)]


def test_percent_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 800), (0, 5), (1, 0)], "p bigint, w bigint")
    got = [r[0] for r in df.select(measures.percent(F.col("p"), F.col("w")).cast("double")).collect()]
    assert got == [33.33, 0.13, 0.0, None]


def test_dim_date(spark):
    days = {r["date_key"]: r for r in dim_date(spark).collect()}
    assert len(days) == 1096
    assert min(days) == 20080101 and max(days) == 20101231
    saturday, sunday, monday = days[20080105], days[20080106], days[20080107]
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (6, "Sat", True)
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sun", True)
    assert (monday.day_of_week, monday.is_weekend) == (1, False)
    leap = days[20080229]
    assert leap.full_date == date(2008, 2, 29) and leap.month_name == "Feb" and leap.quarter == 1
    # ISO weeks: 29 December 2008 is in week 1 of the next year
    assert days[20081229].week == 1
    assert all(r.fiscal_year == r.year and r.fiscal_quarter == r.quarter for r in days.values())


def test_dim_date_other_range(spark):
    assert dim_date(spark, date(2011, 1, 1), date(2011, 1, 10)).count() == 10
