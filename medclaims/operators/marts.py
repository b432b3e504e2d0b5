"""Pre-aggregated marts (M1-M3) and their slimmer refresh variants.

A claim_key occurs once in the fact and each dimension row at most once per
key, so COUNT(DISTINCT claim_key) is COUNT(*). That leaves one DISTINCT, which
Spark computes without multiplying rows; it shuffles on the group *and* the
patient first, so a hot month, category or code is spread over tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.functions import calendar as cal
from medclaims.functions import measures
from medclaims.operators.keys import with_ranks
from medclaims.sources.tables import TableStore


def mart_monthly(fact: DataFrame, dates: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """M1: month x claim type x diagnosis category.

    J4: claims without a calendar day drop out; J4b: claims without a diagnosis
    stay, with category NULL. The calendar has a fixed number of days, so it is
    broadcast. Year and month follow from the month's first day, so only that is
    grouped on (A13).
    """
    calendar = dates.select("date_key", cal.month_start(F.col("full_date")).alias("month_date"))
    categories = diagnoses.select("diagnosis_key", "diagnosis_category")
    claims = fact.join(F.broadcast(calendar), fact.claim_from_date_key == calendar.date_key).join(
        categories, fact.primary_diagnosis_key == categories.diagnosis_key, "left"
    )
    grouped = claims.groupBy("month_date", "claim_type", "diagnosis_category").agg(
        F.count("*").alias("claim_count"),
        F.countDistinct("patient_key").alias("unique_patients"),
        measures.total("claim_payment_amount").alias("total_paid"),
        measures.mean_amount("claim_payment_amount").alias("avg_paid_per_claim"),
        F.avg("utilization_days").alias("avg_length_of_stay"),
        F.sum("utilization_days").alias("total_utilization_days"),
    )
    month = F.col("month_date")
    return grouped.select(
        F.year(month).alias("year"),
        F.month(month).alias("month"),
        F.monthname(month).alias("month_name"),
        *grouped.columns,
    )


def mart_monthly_etl(monthly: DataFrame) -> DataFrame:
    """As the refresh job of the source system stores it."""
    return monthly.drop("total_utilization_days")


def mart_diagnosis_etl(fact: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Code x claim type, without ranks.

    Claims are grouped on the diagnosis key; texts join the few grouped rows.
    """
    grouped = (
        fact.where(F.col("primary_diagnosis_key").isNotNull())
        .groupBy("primary_diagnosis_key", "claim_type")
        .agg(
            F.count("*").alias("claim_count"),
            F.countDistinct("patient_key").alias("patient_count"),
            measures.total("claim_payment_amount").alias("total_paid"),
            measures.mean_amount("claim_payment_amount").alias("avg_paid_per_claim"),
            F.avg("utilization_days").alias("avg_length_of_stay"),
        )
    )
    return grouped.join(diagnoses, grouped.primary_diagnosis_key == diagnoses.diagnosis_key).select(
        "icd9_code", "diagnosis_description", "diagnosis_category", *grouped.columns[1:]
    )


def mart_diagnosis(fact: DataFrame, diagnoses: DataFrame, store: TableStore) -> DataFrame:
    """Ranked by cost and by volume within the claim type; ties by code."""
    ranks = {"rank_by_cost": "total_paid", "rank_by_volume": "claim_count"}
    return with_ranks(mart_diagnosis_etl(fact, diagnoses), ranks, "icd9_code", store, ["claim_type"])


def mart_provider_etl(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Inpatient providers with their share of long stays, without ranks.

    A stay of unknown length counts as not long and stays in the denominator.
    """
    long_stays = F.count_if(F.col("utilization_days") > V.LONG_STAY_DAYS)
    grouped = (
        fact.where((F.col("claim_type") == V.INPATIENT) & F.col("provider_key").isNotNull())
        .groupBy("provider_key")
        .agg(
            F.count("*").alias("total_claims"),
            F.countDistinct("patient_key").alias("unique_patients"),
            measures.total("claim_payment_amount").alias("total_revenue"),
            measures.mean_amount("claim_payment_amount").alias("avg_claim_amount"),
            F.avg("utilization_days").alias("avg_length_of_stay"),
            measures.percent(long_stays, F.count("*")).alias("pct_long_stays"),
        )
    )
    names = providers.select("provider_key", "provider_id", "provider_type")
    return grouped.join(names, "provider_key").select("provider_id", "provider_type", *grouped.columns[1:])


def mart_provider(fact: DataFrame, providers: DataFrame, store: TableStore) -> DataFrame:
    """Ranked by revenue and by volume over all providers; ties by provider."""
    ranks = {"revenue_rank": "total_revenue", "volume_rank": "total_claims"}
    return with_ranks(mart_provider_etl(fact, providers), ranks, "provider_id", store)
