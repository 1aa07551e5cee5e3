"""Exact quartiles, box-plot figures and density histograms per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.operators.joins import join_null_safe, skew_join
from sparkclaims.storage import materialize

# Bins of one round, and rows between two bounds that are sorted as they are.
BINS = 4_096
SORTED_ROWS = 100_000


def _bin(bins: int) -> Column:
    """The bin of ``_value`` between ``_low`` and ``_high``; both ends differ in it."""
    share = F.try_divide(F.col("_value") - F.col("_low"), F.col("_high") - F.col("_low"))
    return F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0))


def _binned(rows: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Per bin its rows, its least and greatest value, and the rows before it.

    Counted map-side; the window sees at most ``bins`` rows per range.
    """
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*keys, _bin(bins).alias("_bin"))
        .agg(F.count("*").alias("_inside"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
        .withColumn("_earlier", F.coalesce(F.sum("_inside").over(before), F.lit(0)))
    )


def _value_at_ranks(
    known: DataFrame, group: Sequence[str], places: Column, bins: int, sorted_rows: int
) -> DataFrame:
    """``_rank`` (from 0) and ``_at``, the value there, for the ranks in the array
    ``places`` (an expression of ``n``) of each group, and ``n``.

    A range of values holds each rank: at first the group's, then the bin of
    the last round, until it has one value or few rows.
    """
    ends = materialize(
        known.groupBy(*group).agg(
            F.count("*").alias("n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
        ),
        "ends",
    )
    sizes = ends.select(*group, F.col("n").alias("_rows"))
    ranks = ends.select(*group, "n", F.explode(F.array_distinct(places)).alias("_rank"))
    # The ranks of a group share its first range.
    ranged = skew_join(known, ends.drop("n"), group, "inner", null_safe=True, frequencies=lambda: sizes)
    first = join_null_safe(ranks, _binned(ranged, group, bins), group, "inner")
    chosen = materialize(_held(first, group, F.lit(0)), "ranges")
    while chosen.filter((F.col("_low") < F.col("_high")) & (F.col("_inside") > sorted_rows)).limit(1).count():
        rows = _between(known, chosen.drop("n", "_inside"), group, sizes)
        inner = _binned(rows, [*group, "_rank", "_before"], bins)
        held = _held(inner.withColumn("n", F.lit(0).cast("long")), group, F.col("_before")).drop("n")
        chosen = materialize(
            join_null_safe(held, chosen.select(*group, "_rank", "n"), [*group, "_rank"], "inner"), "ranges"
        )
    rows = _between(known, chosen.filter(F.col("_low") < F.col("_high")).drop("n", "_inside"), group, sizes)
    upto = Window.partitionBy(*group, "_rank").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        rows.groupBy(*group, "_rank", "_before", "_value")
        .agg(F.count("*").alias("_count"))
        .withColumn("_upto", F.col("_before") + F.sum("_count").over(upto))
        .filter((F.col("_upto") - F.col("_count") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto")))
        .select(*group, "_rank", F.col("_value").alias("_found"))
    )
    return join_null_safe(chosen, found, [*group, "_rank"], "left").select(
        *group, "n", "_rank", F.coalesce("_found", "_low").alias("_at")
    )


def _held(binned: DataFrame, group: Sequence[str], before: Column) -> DataFrame:
    """The bin that holds each rank, as its next range."""
    earlier = before + F.col("_earlier")
    return binned.filter((earlier <= F.col("_rank")) & (F.col("_rank") < earlier + F.col("_inside"))).select(
        *group, "n", "_rank", F.col("_least").alias("_low"), F.col("_most").alias("_high"),
        earlier.alias("_before"), "_inside",
    )


def _between(known: DataFrame, ranges: DataFrame, group: Sequence[str], sizes: DataFrame) -> DataFrame:
    """The rows inside each range."""
    inside = (F.col("_value") >= F.col("_low")) & (F.col("_value") <= F.col("_high"))
    return skew_join(known, ranges, group, "inner", null_safe=True, residual=inside, frequencies=lambda: sizes)


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: dict[str, float],
    bins: int = BINS,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """n and exact quantiles per group, linearly interpolated; ``probs`` maps
    output names to fractions.

    No row is sorted or shuffled but those of the bins that hold the wanted
    ranks; the counts per bin collapse map-side.
    """
    known = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_value"))
    places = {name: (F.col("n") - 1) * F.lit(p) for name, p in probs.items()}
    wanted = F.array(*[f(place).cast("long") for place in places.values() for f in (F.floor, F.ceil)])
    found = _value_at_ranks(known, group, wanted, bins, sorted_rows)

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("_at")))

    picked = found.groupBy(*group, "n").agg(
        *[at(F.floor(place)).alias(f"_low_{name}") for name, place in places.items()],
        *[at(F.ceil(place)).alias(f"_high_{name}") for name, place in places.items()],
    )
    between = {
        name: F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (place - F.floor(place))
        for name, place in places.items()
    }
    return picked.select(*group, "n", *[quantile.alias(name) for name, quantile in between.items()])


def box_stats(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    whisker: float = 1.5,
    bins: int = BINS,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """n, q1, median, q3, whisker ends and number of outliers per group.

    A whisker ends at the most extreme value within ``whisker`` times the
    interquartile range, and never inside the box.
    """
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = materialize(exact_quantiles(df, group, value, quartiles, bins, sorted_rows), "boxes")
    reach = (F.col("q3") - F.col("q1")) * whisker
    v = F.col("_value")
    below, above = v < F.col("q1") - reach, v > F.col("q3") + reach
    known = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_value"))
    sizes = boxes.select(*group, F.col("n").alias("_rows"))
    return (
        skew_join(known, boxes, group, "inner", null_safe=True, frequencies=lambda: sizes)
        .groupBy(*group, "n", "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(~below, v)), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(~above, v)), F.col("q3")).alias("whisker_high"),
            F.sum((below | above).cast("long")).alias("outliers"),
        )
    )


def outlier_rows(df: DataFrame, boxes: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The rows of ``df`` beyond the whiskers of ``box_stats``."""
    ends = boxes.select(*group, "whisker_low", "whisker_high")
    v = F.col(value).cast("double")
    return (
        skew_join(df, ends, group, "inner", null_safe=True)
        .filter((v < F.col("whisker_low")) | (v > F.col("whisker_high")))
        .select(*df.columns)
    )


def density_histogram(df: DataFrame, group: str, value: str, bins: int = 25) -> DataFrame:
    """Equal-width bins between each group's least and greatest value.

    Every bin is reported, the last one includes its upper edge. A constant
    column gets the unit-wide range centred on its value.
    """
    v = F.col(value).cast("double")
    known = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).select(
        group, v.alias("_value")
    )
    flat = F.col("_low") == F.col("_high")
    ranges = materialize(
        known.groupBy(group)
        .agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.count("*").alias("n"))
        .select(
            group,
            "n",
            F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("low"),
            (F.when(flat, F.lit(1.0)).otherwise(F.col("_high") - F.col("_low")) / bins).alias("width"),
        ),
        "ranges",
    )
    place = F.least(F.floor((F.col("_value") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    counts = (
        skew_join(known, ranges, [group], "inner")
        .groupBy(group, place.cast("int").alias("bin"))
        .agg(F.count("*").alias("_count"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = F.coalesce(F.col("_count"), F.lit(0))
    return grid.join(counts, [group, "bin"], "left").select(
        group,
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_low"),
        filled.alias("bin_count"),
        (filled / (F.col("n") * F.col("width"))).alias("density"),
    )
