"""Figures behind the dashboard charts.

Groups whose key is null do not appear, as in the charts.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.functions.bands import AGE_LABELS, INCOME_LABELS
from sparkclaims.functions.columns import mean_of, pct
from sparkclaims.functions.risk import rate_level
from sparkclaims.operators.distribution import box_stats, density_histogram
from sparkclaims.operators.grouping import in_fixed_order, pivot_rate
from sparkclaims.plans.star import ClaimStar, aggregate, count_claims, fraud_claims

# Order of the claim statuses in the chart.
STATUS_ORDER = ["Approved", "Pending", "Rejected", "Under Investigation", "Settled"]


def _counts():
    return {"total": count_claims(), "fraud": fraud_claims()}


def _rate():
    return pct(F.col("fraud"), F.col("total"))


def kpi(claims: DataFrame) -> DataFrame:
    """Claims, amount claimed, fraud claims and fraud percentage, in one row."""
    return claims.agg(
        F.count("*").alias("total_claims"),
        F.sum("claimed_amount").alias("total_claimed"),
        F.sum(fraud_claims()).alias("fraud_claims"),
        pct(F.sum(fraud_claims()), F.count("*")).alias("fraud_rate_pct"),
    )


def type_rates(claims: DataFrame) -> DataFrame:
    """Claims and fraud percentage per claim type, fewest claims first."""
    return (
        claims.filter(F.col("claim_type").isNotNull())
        .groupBy("claim_type")
        .agg(F.count("*").alias("total"), F.sum(fraud_claims()).alias("fraud"))
        .select("claim_type", "total", F.col("fraud").alias("fraud_cnt"), _rate().alias("fraud_rate"))
        .orderBy("total", "claim_type")
    )


def category_rate_band(star: ClaimStar) -> DataFrame:
    """Fraud percentage per policy category, its class, and that of all claims."""
    grains = aggregate(star, ["category"], _counts(), "left")
    overall = grains.agg(pct(F.sum("fraud"), F.sum("total")).alias("rate")).scalar()
    return (
        grains.filter(F.col("category").isNotNull())
        .select("category", _rate().alias("fraud_rate"), overall.alias("overall_rate"))
        .withColumn("rate_class", rate_level(F.col("fraud_rate")))
        .orderBy(F.desc("fraud_rate"), "category")
    )


def monthly_counts(claims: DataFrame, years: Sequence[int]) -> DataFrame:
    """Claims and fraud per month of the given years.

    The range of days is what a scan can skip files by.
    """
    days = F.col("claim_date").between(
        datetime.date(min(years), 1, 1), datetime.date(max(years), 12, 31)
    )
    return (
        claims.filter(days)
        .withColumns({"year": F.year("claim_date"), "month": F.month("claim_date")})
        .filter(F.col("year").isin(list(years)))
        .groupBy("year", "month")
        .agg(F.count("*").alias("count"), F.sum(fraud_claims()).alias("fraud"))
    )


def age_band_rates(star: ClaimStar) -> DataFrame:
    """Fraud percentage and claims for every age band, in order."""
    grains = aggregate(star, ["age_band"], _counts(), "left").select(
        "age_band", _rate().alias("fraud_rate"), F.col("total").alias("count")
    )
    return in_fixed_order(grains, "age_band", AGE_LABELS)


def credit_income_rates(star: ClaimStar) -> DataFrame:
    """Fraud percentage by credit band and income band; 0 where none is."""
    grains = aggregate(star, ["credit_band", "income_band"], _counts(), "left")
    return pivot_rate(grains, "credit_band", "income_band", INCOME_LABELS, "fraud", "total")


def region_performance(star: ClaimStar) -> DataFrame:
    """Claims, fraud, average amount and fraud percentage per region."""
    sums = {
        **_counts(),
        "amount_sum": F.col("claimed_amount"),
        "amount_rows": F.col("claimed_amount").isNotNull().cast("long"),
    }
    return (
        aggregate(star, ["region"], sums, "left")
        .filter(F.col("region").isNotNull())
        .select(
            "region",
            "total",
            "fraud",
            mean_of(F.col("amount_sum"), F.col("amount_rows")).alias("avg_amount"),
            _rate().alias("fraud_rate"),
        )
        .orderBy(F.desc("fraud_rate"), "region")
    )


def amount_by_status(claims: DataFrame, statuses: Sequence[str] = STATUS_ORDER) -> DataFrame:
    """Box-plot figures of the claimed amount for the listed statuses."""
    chosen = claims.filter(F.col("status").isin(list(statuses)))
    return box_stats(chosen, ["status"], "claimed_amount")


def score_histogram(claims: DataFrame, bins: int = 25) -> DataFrame:
    """Density of the fraud score, apart for fraud and other claims."""
    flagged = claims.select(F.col("fraud_flag").cast("boolean").alias("fraud_flag"), "fraud_score")
    return density_histogram(flagged, "fraud_flag", "fraud_score", bins)


def top_cities(star: ClaimStar, places: int = 10) -> DataFrame:
    """Cities with the most fraud claims, classed by the figures shown."""
    fraud = ClaimStar(
        star.claims.filter(F.col("fraud_flag").cast("boolean")),
        star.policies,
        star.customers,
        star.policy_types,
        star.agents,
        star.dates,
    )
    top = (
        aggregate(fraud, ["city"], {"fraud_count": count_claims()}, "left")
        .filter(F.col("city").isNotNull())
        .orderBy(F.desc("fraud_count"), "city")
        .limit(places)
    )
    figures = top.agg(F.array_sort(F.collect_list("fraud_count")).alias("counts"))
    # At most ``places`` figures: their quantile is taken from the sorted array.
    place = (F.size("counts") - 1) * F.lit(0.75)
    low = F.get("counts", F.floor(place).cast("int"))
    high = F.get("counts", F.ceil(place).cast("int"))
    upper = figures.select(low + (high - low) * (place - F.floor(place))).scalar()
    most = figures.select(F.array_max("counts")).scalar()
    return top.withColumn(
        "class",
        F.when(F.col("fraud_count") == most, "danger")
        .when(F.col("fraud_count") >= upper, "warning")
        .otherwise("info"),
    ).orderBy(F.desc("fraud_count"), "city")
