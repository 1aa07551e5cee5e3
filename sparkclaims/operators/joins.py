"""Joins that hold up under skew, and star joins that aggregate on the way."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.storage import materialize

# Rows of one key that a task may get; a key with more is split in as many parts as it takes.
HOT_ROWS = 4_000_000


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own size estimate lets it broadcast ``df`` unhinted."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= broadcast_limit(df)


def sized(df: DataFrame) -> DataFrame:
    """``df``, written first where Catalyst cannot tell whether it may be broadcast.

    Its estimate is near the size of a scan, but for a join or an aggregate only
    a bound: the product of the joined tables, or the whole table that is grouped.
    """
    if fits_broadcast(df):
        return df
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialize(df, "sized") if re.search(r"\b(Join|Aggregate|Generate|Window)\b", plan) else df


def _join_on(left, right, keys, how, null_safe=False, residual=None) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    pairs = [(F.col(k), F.col(f"_right_{k}")) for k in keys]
    condition = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    if residual is not None:
        condition.append(residual)
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left keys."""
    return _join_on(left, right, keys, how, null_safe=True)


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, but a repeated key raises while the rows are read.

    The check is part of the plan: one aggregate that combines map-side.
    """
    rest = [c for c in df.columns if c not in keys]
    checked = df.groupBy(*keys).agg(
        F.when(
            F.count("*") > 1,
            F.raise_error(
                F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*[F.max(k).alias(k) for k in keys])))
            ),
        )
        .otherwise(F.any_value(F.struct(*[F.col(c) for c in rest])) if rest else F.lit(None))
        .alias("_row")
    )
    if not rest:
        return checked.filter(F.col("_row").isNull()).select(*df.columns)
    return checked.select(*keys, "_row.*").select(*df.columns)


def hot_keys(
    frequencies: DataFrame, keys: Sequence[str], hot_rows: int | None = None
) -> DataFrame | None:
    """Every key (null included) with over ``hot_rows`` rows (``HOT_ROWS`` by
    default) and ``_salts``, the parts of at most that many rows it makes; from
    a table of keys and ``_rows``. None without any.

    The table is written, so that both sides of a join see the same list. It
    has at most all rows / ``hot_rows`` rows.
    """
    most = HOT_ROWS if hot_rows is None else hot_rows
    salts = F.ceil(F.col("_rows") / most).cast("int").alias("_salts")
    found = materialize(frequencies.filter(F.col("_rows") > most).select(*keys, salts), "hot_keys")
    return found if found.limit(1).count() else None


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    residual: Column | None = None,
    frequencies: Callable[[], DataFrame] | None = None,
    hot_rows: int | None = None,
    may_broadcast: bool = True,
) -> DataFrame:
    """Left or inner equi-join of a fact with a table of few rows per key.

    A right side within the broadcast threshold is left to Catalyst. Beyond
    it, the rows of each hot key are spread over as many sub-keys as their
    number takes, and only the right rows of those keys are repeated. ``residual`` is a further condition
    on the columns of both sides. ``frequencies`` gives keys and ``_rows``; it spares a
    left side that is itself a join from being run to find the hot keys.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be salted on the left")

    def join(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        return _join_on(a, b, on, how, null_safe, residual)

    if may_broadcast and fits_broadcast(right):
        return join(left, right, [*keys])
    if frequencies is None:
        counted = left.groupBy(*keys).agg(F.count("*").alias("_rows"))
    else:
        counted = frequencies()
    hot = hot_keys(counted, keys, hot_rows)
    if hot is None:
        return join(left, right, [*keys])
    flagged = F.broadcast(hot)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.col("_salts")).cast("int")
    salted_left = join_null_safe(left, flagged, keys, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), part).otherwise(0)
    )
    every = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_right = join_null_safe(right, flagged, keys, "left").withColumn("_salt", F.explode(every))
    return join(salted_left.drop("_salts"), salted_right.drop("_salts"), [*keys, "_salt"]).drop("_salt")


@dataclass(frozen=True)
class Dimension:
    """A table joined to the fact on ``key`` that contributes ``attributes``.

    An attribute may itself be the key of a later dimension.
    """

    table: DataFrame
    key: str
    attributes: Sequence[str]
    how: str = "inner"

    def rows(self) -> DataFrame:
        return self.table.select(self.key, *self.attributes)


def star_aggregate(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    by: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Additive measures of a star join, grouped by ``by``.

    A dimension within the broadcast threshold is joined directly. For a larger
    one, a hot key must not reach the join as it is:

    - When only its key and measures are left, the rows are first summed per
      key. A hot key then arrives as one row per task, and the join reuses the
      shuffle of the sums.
    - When the fact still carries other columns, the rows of hot keys are
      salted. After a first large join they are summed by those columns before.

    Every measure in ``sums`` is a sum; averages are formed afterwards from
    sums and counts. A dimension that is itself a join or an aggregate is
    written, so that its size decides and not Catalyst's bound.
    """
    later_keys = [d.key for d in dimensions]
    needed = [c for c in fact.columns if c in {*later_keys, *by}]
    current = fact.select(*needed, *[value.alias(name) for name, value in sums.items()])
    totals = [F.sum(name).alias(name) for name in sums]
    shuffled = False
    for place, dimension in enumerate(dimensions):
        rows = sized(dimension.rows())
        keys = [c for c in current.columns if c not in sums]
        if fits_broadcast(rows):
            current = current.join(rows, dimension.key, dimension.how)
        elif keys == [dimension.key]:
            current = current.groupBy(*keys).agg(*totals).join(rows, dimension.key, dimension.how)
            shuffled = True
        elif shuffled:
            # Grouped by more than the key, so a hot key still has many rows.
            summed = materialize(current.groupBy(*keys).agg(*totals), "summed")
            current = skew_join(summed, rows, [dimension.key], dimension.how, may_broadcast=False)
        else:
            current = skew_join(current, rows, [dimension.key], dimension.how, may_broadcast=False)
            shuffled = True
        still = {*by, *later_keys[place + 1:], *sums}
        current = current.select(*[c for c in current.columns if c in still])
    return current.groupBy(*by).agg(*totals)
