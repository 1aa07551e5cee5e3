"""Quantiles from mergeable sketches, for summaries that are refreshed by parts.

A sketch of k answers a quantile within ``rank_error(k)`` of its rank, with 99
percent confidence, whatever the rows; it has a few kilobytes and sketches of
disjoint facts merge. The exact forms are in ``distribution``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch.
K = 800


def rank_error(k: int = K) -> float:
    """How far, as a share of the rows, an answer's rank may lie from the wish."""
    # The published fit of the KLL sketch for a single quantile.
    return 2.296 / k**0.9021


def sketch(value: Column, k: int = K) -> Column:
    """Aggregate: a sketch of the values; nulls are left out."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(k))


def merged(column: str | Column, k: int = K) -> Column:
    """Aggregate: one sketch of all rows' sketches."""
    return F.kll_merge_agg_double(column, F.lit(k))


def quantiles(sketched: str | Column, shares: Sequence[float]) -> Column:
    """The values at the ranks ``shares``, as an array; null of an empty sketch."""
    rows = F.kll_sketch_get_n_double(sketched)
    wished = F.array(*[F.lit(float(s)) for s in shares])
    return F.when(rows > 0, F.kll_sketch_get_quantile_double(sketched, wished))


def rank_errors(
    rows: DataFrame, sketched: DataFrame, group: str, value: str, sketch_column: str, shares: Sequence[float]
) -> DataFrame:
    """group, share, estimate, rows and ``error``: how far the wished rank lies from the ranks that
    the estimate truly has in ``rows`` (0 when it is among them). Null values do not count.

    ``sketched`` has one row per group; the true ranks come from one pass that
    sums per group.
    """
    estimates = sketched.select(group, quantiles(sketch_column, shares).alias("_estimates"))
    at = [F.col("_estimates")[k] for k in range(len(shares))]
    counted = (
        rows.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_value"))
        .join(estimates, group)
        .groupBy(group)
        .agg(
            F.count("*").alias("rows"), F.any_value("_estimates").alias("_estimates"),
            F.array(*[F.count_if(F.col("_value") < e) for e in at]).alias("_below"),
            F.array(*[F.count_if(F.col("_value") <= e) for e in at]).alias("_upto"),
        )
    )
    wished = F.array(*[F.lit(float(s)) for s in shares])
    each = F.explode(F.arrays_zip(wished.alias("share"), F.col("_estimates").alias("estimate"), F.col("_below").alias("below"), F.col("_upto").alias("upto")))
    listed = counted.select(group, "rows", each.alias("_at")).select(group, "rows", "_at.*")
    low, high = F.col("below") / F.col("rows"), F.col("upto") / F.col("rows")
    error = F.greatest(low - F.col("share"), F.col("share") - high, F.lit(0.0))
    return listed.select(group, "share", "estimate", "rows", error.alias("error"))
