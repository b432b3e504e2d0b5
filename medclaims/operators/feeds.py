"""Result tables for dashboards (B1-B6, O4), read from the marts."""

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medclaims import fixed_values as V
from medclaims.functions import calendar as cal
from medclaims.functions import measures
from medclaims.schemas import TOTAL


def filter_category(df: DataFrame, categories: Collection[str]) -> DataFrame:
    """Keep some diagnosis categories of any feed that has them."""
    return df.where(F.col("diagnosis_category").isin(*categories))


def _of_categories(
    monthly: DataFrame, fact: DataFrame, diagnoses: DataFrame | None, categories: Collection[str] | None
) -> tuple[DataFrame, DataFrame]:
    """Mart rows and claims of the same categories, so that sums and exact figures agree."""
    if categories is None:
        return monthly, fact
    if diagnoses is None:
        raise ValueError("categories need the diagnoses")
    keys = filter_category(diagnoses, categories).select(F.col("diagnosis_key").alias("primary_diagnosis_key"))
    return filter_category(monthly, categories), fact.join(keys, "primary_diagnosis_key", "left_semi")


def kpi_cards(
    monthly: DataFrame,
    fact: DataFrame,
    dates: DataFrame,
    diagnoses: DataFrame | None = None,
    categories: Collection[str] | None = None,
) -> DataFrame:
    """B1: the headline figures in one row.

    Sums add up over the monthly mart, and paid per claim is their ratio.
    Patients and stays do not add up over groups: ``*_sum`` and ``*_mean`` are
    what the mart alone gives (a mean of its rows, each to six decimals, so that
    their order does not matter), ``*_exact`` come from the fact's claims that have
    a calendar day, the ones in the mart. ``categories`` (B6) restrict both.
    """
    monthly, fact = _of_categories(monthly, fact, diagnoses, categories)
    stays = F.col("avg_length_of_stay").cast("decimal(18,6)")
    cards = monthly.agg(
        F.sum("total_paid").cast(TOTAL).alias("total_paid"),
        F.sum("claim_count").alias("claim_count"),
        F.sum("unique_patients").alias("unique_patients_sum"),
        measures.safe_ratio(F.sum("total_paid").cast("double"), F.sum("claim_count")).alias("avg_paid_per_claim"),
        measures.safe_ratio(F.sum(stays).cast("double"), F.count(stays)).alias("avg_length_of_stay_mean"),
    )
    calendar = F.broadcast(dates.select(F.col("date_key").alias("claim_from_date_key")))
    exact = fact.join(calendar, "claim_from_date_key").agg(
        F.countDistinct("patient_key").alias("unique_patients_exact"),
        F.avg("utilization_days").alias("avg_length_of_stay_exact"),
    )
    # two one-row aggregates side by side: stack them and take what is not NULL
    both = cards.unionByName(exact, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def top_diagnoses(mart: DataFrame, n: int = 10, by: str = "cost", claim_type: str | None = None) -> DataFrame:
    """The ``n`` leading diagnoses of each claim type, from the stored rank."""
    ranks = {"cost": "rank_by_cost", "volume": "rank_by_volume"}
    top = mart.where(F.col(ranks[by]) <= n)
    return top if claim_type is None else top.where(F.col("claim_type") == claim_type)


def diagnoses_by_stay(mart: DataFrame) -> DataFrame:
    """Diagnoses by mean length of stay, unknown stays last."""
    return mart.select(
        "icd9_code", "diagnosis_description", "diagnosis_category", "claim_type", "avg_length_of_stay"
    ).orderBy(F.col("avg_length_of_stay").desc_nulls_last(), "icd9_code", "claim_type")


def cost_vs_utilization(mart: DataFrame) -> DataFrame:
    """Cost against stay, one point per diagnosis and claim type."""
    return mart.select(
        "icd9_code", "diagnosis_description", "diagnosis_category", "claim_type",
        "claim_count", "total_paid", "avg_paid_per_claim", "avg_length_of_stay",
    )


def monthly_trend(
    monthly: DataFrame,
    fact: DataFrame,
    dates: DataFrame,
    claim_type: str = V.INPATIENT,
    diagnoses: DataFrame | None = None,
    categories: Collection[str] | None = None,
) -> DataFrame:
    """Cost, volume and stay per month of one claim type.

    Cost, claims and days add up over the categories of the mart. The mean of
    the known stays does not, so ``avg_length_of_stay_exact`` comes from the fact.
    ``categories`` (B6) restrict both.
    """
    monthly, fact = _of_categories(monthly, fact, diagnoses, categories)
    trend = (
        monthly.where(F.col("claim_type") == claim_type)
        .groupBy("month_date")
        .agg(
            F.sum("total_paid").cast(TOTAL).alias("total_paid"),
            F.sum("claim_count").alias("claim_count"),
            F.sum("total_utilization_days").alias("total_utilization_days"),
        )
    )
    calendar = dates.select(
        F.col("date_key").alias("claim_from_date_key"), cal.month_start(F.col("full_date")).alias("month_date")
    )
    stays = (
        fact.where(F.col("claim_type") == claim_type)
        .join(F.broadcast(calendar), "claim_from_date_key")
        .groupBy("month_date")
        .agg(F.avg("utilization_days").alias("avg_length_of_stay_exact"))
    )
    per_claim = F.col("total_utilization_days").cast("double") / F.col("claim_count")
    return (
        trend.join(stays, "month_date")
        .withColumn("stay_days_per_claim", per_claim)
        .orderBy("month_date")
    )
