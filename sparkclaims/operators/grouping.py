"""ROLLUP, CUBE and pivots that expand aggregated rows, not facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.storage import local_table


def _labelled(grouped, by: Sequence[str], labels: Mapping[str, str], sums: Sequence[str]) -> DataFrame:
    return grouped.agg(
        *[
            F.when(F.grouping(name) == 1, labels[name])
            .otherwise(F.col(name).cast("string"))
            .alias(f"_label_{name}")
            for name in by
        ],
        F.grouping_id().alias("grouping_id"),
        *[F.sum(name).alias(name) for name in sums],
    ).select(
        *[F.col(f"_label_{name}").alias(name) for name in by], "grouping_id", *sums
    )


def rollup_labelled(
    grains: DataFrame, by: Sequence[str], labels: Mapping[str, str], sums: Sequence[str]
) -> DataFrame:
    """Subtotals of already grouped sums, from the full key up to the total.

    ``labels`` names the "all" value per column. A null in the data stays null,
    and ``grouping_id`` tells it from a subtotal.
    """
    return _labelled(grains.rollup(*by), by, labels, sums)


def cube_labelled(
    grains: DataFrame, by: Sequence[str], labels: Mapping[str, str], sums: Sequence[str]
) -> DataFrame:
    """Subtotals of already grouped sums over every subset of ``by``."""
    return _labelled(grains.cube(*by), by, labels, sums)


def pivot_rate(
    grains: DataFrame, rows: str, across: str, values: Sequence[str], part: str, whole: str
) -> DataFrame:
    """100 * part / whole per ``rows`` and listed value of ``across``; absent is 0."""

    def cell(value: str) -> Column:
        chosen = F.col(across) == value
        rate = F.try_divide(
            F.lit(100.0) * F.sum(F.when(chosen, F.col(part))).cast("double"),
            F.sum(F.when(chosen, F.col(whole))).cast("double"),
        )
        return F.coalesce(rate, F.lit(0.0)).alias(value)

    return (
        grains.filter(F.col(rows).isNotNull() & F.col(across).isNotNull())
        .groupBy(rows)
        .agg(*[cell(value) for value in values])
    )


def in_fixed_order(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """One row per value of ``domain`` in that order; figures are null if absent."""
    listed = local_table(
        df.sparkSession,
        {column: list(domain), "position": list(range(1, len(domain) + 1))},
        f"{column} string, position int",
    )
    return listed.join(df, column, "left").orderBy("position")
