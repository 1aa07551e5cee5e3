"""The analytical reports over claims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.functions.columns import mean_of, rounded_avg, rounded_ratio
from sparkclaims.functions.risk import (
    composite_label,
    composite_risk,
    customer_risk_level,
    payout_ratio,
)
from sparkclaims.operators.grouping import cube_labelled, rollup_labelled
from sparkclaims.operators.joins import skew_join
from sparkclaims.operators.positions import global_ntile, moving_sums, percent_rank, running_sums
from sparkclaims.plans.star import ClaimStar, aggregate, count_claims, fraud_claims, score_sums
from sparkclaims.storage import materialize
from sparkclaims.storage import local_table

CLAIM_TYPE_TEXTS = {
    # Descriptions of the claim types.
    "Accident": "Vehicle/person collision",
    "Theft": "Stolen property",
    "Natural Disaster": "Weather/earthquake",
    "Medical": "Health treatment",
    "Fire": "Fire damage",
    "Flood": "Water damage",
    "Injury": "Personal injury",
}


def claims_by_type(claims: DataFrame) -> DataFrame:
    """Counts, averages and fraud share per claim type, highest share first."""
    return (
        claims.groupBy("claim_type")
        .agg(
            F.count("*").alias("claim_count"),
            rounded_avg(F.col("claimed_amount"), 2).alias("avg_claimed"),
            rounded_avg(F.col("approved_amount"), 2).alias("avg_approved"),
            rounded_avg(F.col("fraud_score"), 4).alias("avg_fraud_score"),
            F.sum(fraud_claims()).alias("fraud_count"),
            rounded_ratio(F.sum(fraud_claims()) * 100, F.count("*"), 2).alias("fraud_pct"),
            rounded_avg(F.col("processing_days"), 1).alias("avg_processing_days"),
        )
        .orderBy(F.desc_nulls_last("fraud_pct"), "claim_type")
    )


def fraud_by_category(star: ClaimStar) -> DataFrame:
    """Claims and fraud per policy category; claims without one count as null."""
    sums = {
        "total_claims": count_claims(),
        "fraud_claims": fraud_claims(),
        "amount_sum": F.col("claimed_amount"),
        "amount_rows": F.col("claimed_amount").isNotNull().cast("long"),
        **score_sums(),
    }
    return (
        aggregate(star, ["category"], sums, "left")
        .select(
            "category",
            "total_claims",
            "fraud_claims",
            rounded_ratio(F.col("fraud_claims") * 100, F.col("total_claims"), 2).alias("fraud_rate_pct"),
            rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("avg_fraud_score"),
            rounded_ratio(F.col("amount_sum"), F.col("amount_rows"), 2).alias("avg_claim_amount"),
        )
        .orderBy(F.desc_nulls_last("fraud_rate_pct"), "category")
    )


def running_fraud(
    claims: DataFrame, tie: Sequence[str], keep: Sequence[str] = ("claim_id",)
) -> DataFrame:
    """Fraud count and average score up to each claim of its type, by date.

    ``tie`` makes the order of claims on one day definite. Only ``keep`` and
    the columns in use travel through the sort.
    """
    used = dict.fromkeys([*keep, "claim_type", "claim_date", "fraud_flag", "fraud_score"])
    rows = running_sums(
        claims.select(*dict.fromkeys([*used, *tie])),
        ["claim_type"],
        ["claim_date", *tie],
        {"running_fraud_count": fraud_claims(), **score_sums()},
    )
    return rows.select(
        *used,
        "running_fraud_count",
        rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("running_fraud_score_avg"),
    )


def scored_claims(claims: DataFrame) -> DataFrame:
    """Claims with the composite risk and its label."""
    return claims.withColumn(
        "composite_risk",
        composite_risk(F.col("fraud_score"), F.col("claimed_amount"), F.col("processing_days")),
    ).withColumn("risk_label", composite_label(F.col("composite_risk")))


def with_descriptions(df: DataFrame, column: str, texts: dict[str, str], name: str) -> DataFrame:
    """Adds the text of each code; unknown and null codes get ``Unknown``."""
    lookup = local_table(
        df.sparkSession,
        {column: list(texts), name: list(texts.values())},
        f"{column} string, {name} string",
    )
    return df.join(F.broadcast(lookup), column, "left").na.fill({name: "Unknown"})


def risk_label_counts(claims: DataFrame) -> DataFrame:
    """Claims per risk label, most frequent first."""
    return (
        scored_claims(claims)
        .groupBy("risk_label")
        .agg(F.count("*").alias("claim_count"))
        .orderBy(F.desc("claim_count"), "risk_label")
    )


def fraud_type_counts(claims: DataFrame) -> DataFrame:
    return (
        claims.filter(F.col("fraud_flag").cast("boolean"))
        .groupBy("claim_type")
        .agg(F.count("*").alias("count"))
    )


def high_fraud(claims: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Fraud claims with a score above ``threshold``.

    The threshold takes the column's type, so that the comparison reaches the scan.
    """
    least = F.lit(threshold).cast(claims.schema["fraud_score"].dataType)
    return claims.filter(F.col("fraud_flag").cast("boolean") & (F.col("fraud_score") > least)).select("claim_id", "fraud_score", "status")


def customer_risk(star: ClaimStar, levels: Sequence[str] = ("CRITICAL", "HIGH")) -> DataFrame:
    """Customers whose claims put them in one of ``levels``, highest score first."""
    sums = {
        "total_claims": count_claims(),
        "claimed_sum": F.col("claimed_amount"),
        "fraud_claim_count": fraud_claims(),
        **score_sums(),
    }
    per_customer = aggregate(star, ["customer_id"], sums)
    people = star.current_customers().select(
        "customer_id", "full_name", "credit_band", "income_band"
    )
    avg_score = mean_of(F.col("score_sum"), F.col("score_rows"))
    return (
        per_customer.withColumn("_avg", avg_score)
        .withColumn(
            "risk_level",
            customer_risk_level(F.col("_avg"), F.col("fraud_claim_count"), F.col("total_claims")),
        )
        .filter(F.col("risk_level").isin(list(levels)))
        .join(people, "customer_id")
        .select(
            "customer_id",
            "full_name",
            "credit_band",
            "income_band",
            "total_claims",
            F.round("claimed_sum", 2).alias("total_claimed"),
            rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("avg_fraud_score"),
            "fraud_claim_count",
            "risk_level",
        )
        .orderBy(F.desc_nulls_first("avg_fraud_score"), F.desc("total_claims"), "customer_id")
    )


def monthly_trend(star: ClaimStar) -> DataFrame:
    """Claims per month and policy type with year-to-date sums, growth over the
    month before within the year, and rank by amount within the month."""
    months = aggregate(
        star,
        ["year", "month", "month_name", "policy_type_name"],
        {"claim_count": count_claims(), "claimed_sum": F.col("claimed_amount")},
    )
    in_year = Window.partitionBy("policy_type_name", "year").orderBy("month")
    so_far = in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_amount = Window.partitionBy("year", "month").orderBy(F.desc_nulls_first("claimed_sum"))
    previous = F.lag("claim_count", 1).over(in_year)
    return (
        months.withColumn("prev_month_count", previous)
        .select(
            "year",
            "month",
            "month_name",
            "policy_type_name",
            "claim_count",
            F.round("claimed_sum", 2).alias("total_claimed"),
            F.sum("claim_count").over(so_far).alias("ytd_claim_count"),
            F.sum("claimed_sum").over(so_far).alias("ytd_claimed_amount"),
            "prev_month_count",
            rounded_ratio(
                (F.col("claim_count") - F.col("prev_month_count")) * 100,
                F.col("prev_month_count"),
                2,
            ).alias("mom_growth_pct"),
            F.rank().over(by_amount).alias("rank_by_amount"),
        )
        .orderBy("policy_type_name", "year", "month")
    )


def next_month(star: ClaimStar) -> DataFrame:
    """Claims per month and policy type beside those of the following month."""
    months = aggregate(
        star, ["year", "month", "policy_type_name"], {"claim_count": count_claims()}
    )
    ordered = Window.partitionBy("policy_type_name").orderBy("year", "month")
    return months.withColumn("next_month_count", F.lead("claim_count", 1).over(ordered))


def fraud_percentile(
    star: ClaimStar, tie: Sequence[str], keep: Sequence[str] = ("claim_id",)
) -> DataFrame:
    """Percentile of each claim's score within its policy type, and the average
    score over seven claims around it by date."""
    shown = dict.fromkeys([*keep, "claimed_amount", "fraud_score", "status"])
    claims = star.claims.select(*dict.fromkeys([*shown, "policy_id", "date_key", *tie]))
    # The join runs once: what is sorted, sampled and counted is its written result.
    placed = materialize(
        skew_join(claims, star.policies.select("policy_id", "policy_type_id"), ["policy_id"], "inner"), "placed",
        compression="zstd",
    )
    around = moving_sums(placed, ["policy_type_id"], ["date_key", *tie], score_sums(), 3, 3)
    ranked = percent_rank(
        around, ["policy_type_id"], "fraud_score", "fraud_percentile", digits=2, counted=placed
    )
    named = skew_join(
        ranked, star.policy_types.select("policy_type_id", "policy_type_name"), ["policy_type_id"], "inner"
    )
    return named.select(
        *shown,
        "policy_type_name",
        "fraud_percentile",
        rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("rolling_avg_fraud_score"),
    )


def risk_quartile(
    claims: DataFrame, tie: Sequence[str], keep: Sequence[str] = ("claim_id",)
) -> DataFrame:
    """Quarter of all claims, by falling score, that each claim is in."""
    rows = claims.select(*dict.fromkeys([*keep, "fraud_score", *tie]))
    order = [F.desc_nulls_first("fraud_score"), *tie]
    return global_ntile(rows, 4, order, "risk_quartile").select(
        *dict.fromkeys([*keep, "fraud_score"]), "risk_quartile"
    )


def claims_rollup(star: ClaimStar) -> DataFrame:
    """Region, policy type, year and all their subtotals."""
    ratio = payout_ratio(F.col("approved_amount"), F.col("claimed_amount"))
    sums = {
        "total_claims": count_claims(),
        "claimed_sum": F.col("claimed_amount"),
        "approved_sum": F.col("approved_amount"),
        "payout_sum": ratio.cast("decimal(12,4)"),
        "payout_rows": ratio.isNotNull().cast("long"),
        "fraud_claims": fraud_claims(),
    }
    by = ["region", "policy_type_name", "year"]
    labels = {"region": "ALL REGIONS", "policy_type_name": "ALL POLICIES", "year": "ALL YEARS"}
    return (
        rollup_labelled(aggregate(star, by, sums), by, labels, list(sums))
        .select(
            "region",
            F.col("policy_type_name").alias("policy_type"),
            "year",
            "grouping_id",
            "total_claims",
            F.round("claimed_sum", 2).alias("total_claimed"),
            F.round("approved_sum", 2).alias("total_approved"),
            rounded_ratio(F.col("payout_sum") * 100, F.col("payout_rows"), 2).alias("avg_payout_pct"),
            "fraud_claims",
        )
        .orderBy("region", "policy_type", "year", "grouping_id")
    )


def fraud_cube(star: ClaimStar) -> DataFrame:
    """Fraud over every combination of age band, gender and policy category."""
    by = ["age_band", "gender", "category"]
    sums = {"claim_count": count_claims(), "fraud_count": fraud_claims(), **score_sums()}
    return (
        cube_labelled(aggregate(star, by, sums), by, dict.fromkeys(by, "ALL"), list(sums))
        .select(
            "age_band",
            "gender",
            F.col("category").alias("policy_category"),
            "grouping_id",
            "claim_count",
            "fraud_count",
            rounded_ratio(F.col("fraud_count") * 100, F.col("claim_count"), 2).alias("fraud_rate_pct"),
            rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("avg_fraud_score"),
        )
        .orderBy(F.desc_nulls_last("fraud_rate_pct"), "age_band", "gender", "policy_category")
    )


def summary_sums(star: ClaimStar) -> DataFrame:
    """The stored form of the claim summary: sums and counts, so that it can be
    refreshed by adding."""
    sums = {
        "claim_count": count_claims(),
        "total_claimed": F.col("claimed_amount"),
        "total_approved": F.col("approved_amount"),
        "fraud_score_sum": F.col("fraud_score"),
        "fraud_score_rows": F.col("fraud_score").isNotNull().cast("long"),
        "fraud_count": fraud_claims(),
    }
    return aggregate(star, ["year", "quarter", "policy_type_name", "region"], sums)


def claim_summary(sums: DataFrame) -> DataFrame:
    """The summary as it is read, from its stored form."""
    return sums.select(
        "year",
        "quarter",
        "policy_type_name",
        "region",
        "claim_count",
        "total_claimed",
        "total_approved",
        mean_of(F.col("fraud_score_sum"), F.col("fraud_score_rows")).alias("avg_fraud_score"),
        "fraud_count",
    )


def fraud_summary(sums: DataFrame) -> DataFrame:
    """The rounded summary of fraud, from the stored form."""
    return sums.select(
        "year",
        "quarter",
        "policy_type_name",
        "region",
        "claim_count",
        "fraud_count",
        rounded_ratio(F.col("fraud_score_sum"), F.col("fraud_score_rows"), 4).alias("avg_fraud_score"),
        F.round("total_claimed", 2).alias("total_claimed"),
        F.round("total_approved", 2).alias("total_approved"),
    )


def fraud_hotspots(summary: DataFrame, year: int, more_than: int) -> DataFrame:
    """Rows of the fraud summary of one year with many fraud claims."""
    return summary.filter(
        (F.col("year") == year) & (F.col("fraud_count") > more_than)
    ).orderBy(F.desc_nulls_first("avg_fraud_score"), "quarter", "policy_type_name", "region")


def monthly_fraud_top(star: ClaimStar, places: int = 3) -> DataFrame:
    """Claim types with the most fraud per month (ties share a place), with the
    year's fraud so far and that of the type's previous month."""
    months = aggregate(
        star,
        ["year", "month", "month_name", "claim_type"],
        {
            "total_claims": count_claims(),
            "fraud_claims": fraud_claims(),
            "claimed_sum": F.col("claimed_amount"),
            **score_sums(),
        },
    )
    in_month = Window.partitionBy("year", "month").orderBy(F.desc("fraud_claims"))
    in_year = Window.partitionBy("claim_type", "year").orderBy("month")
    over_time = Window.partitionBy("claim_type").orderBy("year", "month")
    return (
        months.select(
            "year",
            "month",
            "month_name",
            "claim_type",
            "total_claims",
            "fraud_claims",
            rounded_ratio(F.col("score_sum"), F.col("score_rows"), 4).alias("avg_fraud_score"),
            F.col("claimed_sum").alias("total_claimed"),
            F.sum("fraud_claims").over(in_year).alias("ytd_fraud_claims"),
            F.lag("fraud_claims").over(over_time).alias("prev_month_fraud"),
        )
        .withColumn("fraud_rank", F.rank().over(in_month))
        .filter(F.col("fraud_rank") <= places)
        .orderBy("year", "month", "fraud_rank", "claim_type")
    )
