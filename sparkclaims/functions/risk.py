"""Ratios, scores and labels of a claim."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights, caps and thresholds of the scores.
FRAUD_WEIGHT, AMOUNT_WEIGHT, DAYS_WEIGHT = 0.5, 0.3, 0.2
AMOUNT_CAP, DAYS_CAP = 500000, 120
COMPOSITE_LEVELS = [(0.7, "CRITICAL"), (0.5, "HIGH"), (0.3, "MEDIUM")]
ALERT_LEVELS = [(0.8, "\U0001F534 CRITICAL"), (0.5, "\U0001F7E1 HIGH")]
ALERT_DEFAULT = "\U0001F7E2 NORMAL"
RATE_LEVELS = [(13, "danger"), (11, "warning")]
RATE_DEFAULT = "success"


def _first_level(value: Column, levels, default: str, strict: bool = False) -> Column:
    label = F.lit(default)
    for threshold, name in reversed(levels):
        reached = value > threshold if strict else value >= threshold
        label = F.when(reached, name).otherwise(label)
    return label


def as_flag(flag: Column) -> Column:
    """0/1 to boolean; null stays null."""
    return flag.cast("boolean")


def flag_count(flag: Column) -> Column:
    """Per-row 1 or 0 to be summed; null counts as 0."""
    return F.when(flag.cast("boolean"), 1).otherwise(0).cast("long")


def round_half_even(value: Column, digits: int) -> Column:
    """A double rounded as NumPy does: scale, round to even, scale back."""
    return F.rint(value * float(10**digits)) / float(10**digits)


def payout_ratio(approved: Column, claimed: Column) -> Column:
    """approved / claimed at 4 places (half-even), 0 unless claimed is positive."""
    ratio = approved.cast("double") / F.nullif(claimed.cast("double"), F.lit(0.0))
    return round_half_even(F.when(claimed > 0, ratio).otherwise(F.lit(0.0)), 4)


def rejected_amount(claimed: Column, approved: Column) -> Column:
    """claimed - approved at 2 places (half-even); may be negative."""
    return F.bround(claimed - approved, 2)


def max_normalized_risk(
    score: Column, claimed: Column, days: Column, max_claimed: Column, max_days: Column
) -> Column:
    """Weighted score against the largest amount and duration of the table.

    A largest value of 0 makes the score null instead of raising.
    """
    amount = claimed.cast("double") / F.nullif(max_claimed.cast("double"), F.lit(0.0))
    duration = days.cast("double") / F.nullif(max_days.cast("double"), F.lit(0.0))
    return round_half_even(
        score.cast("double") * FRAUD_WEIGHT + amount * AMOUNT_WEIGHT + duration * DAYS_WEIGHT, 4
    )


def composite_risk(score: Column, claimed: Column, days: Column) -> Column:
    """Weighted score against fixed caps; nulls count as 0."""
    zero = F.lit(0.0)
    amount = F.least(F.coalesce(claimed.cast("double"), zero) / AMOUNT_CAP, F.lit(1.0))
    duration = F.least(F.coalesce(days.cast("double"), zero) / DAYS_CAP, F.lit(1.0))
    fraud = F.coalesce(score.cast("double"), zero)
    return F.bround(fraud * FRAUD_WEIGHT + amount * AMOUNT_WEIGHT + duration * DAYS_WEIGHT, 4)


def composite_label(composite: Column) -> Column:
    return _first_level(composite, COMPOSITE_LEVELS, "LOW")


def alert_level(score: Column) -> Column:
    return _first_level(score, ALERT_LEVELS, ALERT_DEFAULT)


def rate_level(rate_pct: Column) -> Column:
    return _first_level(rate_pct, RATE_LEVELS, RATE_DEFAULT, strict=True)


def customer_risk_level(avg_score: Column, fraud_claims: Column, claims: Column) -> Column:
    """First level reached by the average score or by a count; null reaches none."""
    return (
        F.when((avg_score >= 0.7) | (fraud_claims >= 3), "CRITICAL")
        .when((avg_score >= 0.4) | (claims >= 5), "HIGH")
        .when((avg_score >= 0.2) | (claims >= 3), "MEDIUM")
        .otherwise("LOW")
    )
