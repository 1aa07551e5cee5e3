"""Banding of numeric columns into right-closed intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges and labels. None means unbounded above.
AGE_EDGES = [0, 25, 35, 45, 55, 65, 120]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]
INCOME_EDGES = [0, 40000, 80000, 150000, None]
INCOME_LABELS = ["Low", "Medium", "High", "Very High"]
CREDIT_EDGES = [0, 579, 669, 739, 799, 850]
CREDIT_LABELS = ["Poor", "Fair", "Good", "Very Good", "Excellent"]
EXPERIENCE_LABELS = ["Junior", "Mid", "Senior", "Expert"]
PERFORMANCE_LABELS = ["Low", "Average", "High"]
RISK_LABELS = ["Low", "Medium", "High"]


def bin_column(
    value: Column, edges: Sequence, labels: Sequence[str], missing: str | None = None
) -> Column:
    """Label of the interval ``(edges[i], edges[i + 1]]`` that holds ``value``.

    Values outside every interval and nulls get ``missing`` (null by default).
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per interval is needed")
    band = F.lit(None).cast("string") if missing is None else F.lit(missing)
    for low, high, label in reversed(list(zip(edges, edges[1:], labels))):
        inside = value > low
        if high is not None:
            inside = inside & (value <= high)
        band = F.when(inside, label).otherwise(band)
    return band


def age_band(age: Column, missing: str | None = None) -> Column:
    return bin_column(age, AGE_EDGES, AGE_LABELS, missing)


def income_band(income: Column, missing: str | None = None) -> Column:
    return bin_column(income, INCOME_EDGES, INCOME_LABELS, missing)


def credit_band(score: Column, missing: str | None = None) -> Column:
    return bin_column(score, CREDIT_EDGES, CREDIT_LABELS, missing)


def experience_band(years: Column, edges: Sequence) -> Column:
    """Junior, Mid, Senior, Expert; the thresholds are the caller's."""
    return bin_column(years, edges, EXPERIENCE_LABELS)


def performance_band(rating: Column, edges: Sequence) -> Column:
    """Low, Average, High; the thresholds are the caller's."""
    return bin_column(rating, edges, PERFORMANCE_LABELS)


def risk_band(value: Column, edges: Sequence) -> Column:
    """Low, Medium, High for policy types and claim types; caller's thresholds."""
    return bin_column(value, edges, RISK_LABELS)
