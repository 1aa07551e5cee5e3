"""Checks that run before a load, and the gate that stops it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TOLERANCE = 0.05


class QualityError(ValueError):
    """A table did not pass its checks."""


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``duplicates``: rows beyond the first of each key; null keys are equal."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"))
    )


def range_checks(df: DataFrame) -> dict[str, Column]:
    """Conditions of a bad row, for the checked columns that ``df`` has."""
    checks = {}
    if "fraud_score" in df.columns:
        checks["fraud_score_out_of_range"] = (F.col("fraud_score") < 0) | (F.col("fraud_score") > 1)
    if "payout_ratio" in df.columns:
        checks["negative_payout_ratio"] = F.col("payout_ratio") < 0
    return checks


def quality_report(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    null_tolerance: float = NULL_TOLERANCE,
) -> DataFrame:
    """One row: table, rows, null fraction per key column, duplicates, counts of
    out-of-range values, the issues as texts, and whether the table passed.

    One aggregation by key carries all figures, so the table is read once.
    An empty table passes.
    """
    bad = range_checks(df)
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(condition).alias(name) for name, condition in bad.items()],
    )

    def nulls(key: str) -> Column:
        return F.try_divide(
            F.sum(F.when(F.col(key).isNull(), F.col("_rows")).otherwise(0)).cast("double"),
            F.sum("_rows").cast("double"),
        )

    figures = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        *[nulls(key).alias(f"null_pct_{key}") for key in keys],
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bad],
    )
    issues = [
        F.when(
            F.col(f"null_pct_{key}") > null_tolerance,
            F.format_string(
                f"{key}: %.1f%% of the values are missing, {null_tolerance:.0%}% may be",
                F.col(f"null_pct_{key}") * 100,
            ),
        )
        for key in keys
    ]
    issues.append(
        F.when(
            F.col("duplicates") > 0,
            F.format_string(f"%d rows repeat a key of {', '.join(keys)}", F.col("duplicates")),
        )
    )
    texts = {
        "fraud_score_out_of_range": "%d fraud scores outside 0 to 1",
        "negative_payout_ratio": "%d payout ratios under 0",
    }
    issues += [
        F.when(F.col(name) > 0, F.format_string(texts[name], F.col(name))) for name in bad
    ]
    return (
        figures.withColumn("issues", F.array_compact(F.array(*issues)))
        .withColumn("passed", F.size("issues") == 0)
        .select(F.lit(table).alias("table_name"), "*")
    )


def require_quality(report: DataFrame) -> int:
    """Raise if any row of a report failed; otherwise the total number of rows."""
    rows = report.select("table_name", "total_rows", "issues", "passed").collect()
    for row in rows:
        if not row["passed"]:
            raise QualityError(f"quality checks failed for {row['table_name']}: {row['issues']}")
    return sum(row["total_rows"] for row in rows)


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows and nulls per column, in one pass: table_name, column_name, total_rows, null_rows."""
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"_{name}") for name in df.columns],
    )
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"_{name}").alias("null_rows"))
        for name in df.columns
    ]
    return counted.select(
        F.lit(table).alias("table_name"), "total_rows", F.inline(F.array(*entries))
    )
