"""History of a table from changes that arrive in any order.

``merge_scd2`` takes one change per key, each later than the ones before it.
Here every change is kept as an event, so one that arrives late finds its
place: validity periods are drawn between neighbouring events of a key, and
what they look like does not depend on the order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.functions.columns import OPEN_END
from sparkclaims.operators.joins import skew_join
from sparkclaims.operators.positions import neighbours
from sparkclaims.storage import materialize


def add_changes(events: DataFrame, changes: DataFrame, keys: Sequence[str], day: str, order: Sequence[str]) -> DataFrame:
    """The events with further changes: one per key and day.

    Of several on one day the one with the largest ``order`` counts, then the
    one with the largest values, so repeated and reordered loads give the same.
    """
    values = [c for c in events.columns if c not in (*keys, day, *order)]
    latest = F.max(F.struct(*order, *values)).alias("_row")
    return (
        events.unionByName(changes.select(*events.columns))
        .groupBy(*keys, day)
        .agg(latest)
        .select(*keys, day, "_row.*")
        .select(*events.columns)
    )


def periods(
    events: DataFrame,
    keys: Sequence[str],
    day: str,
    tracked: Sequence[str],
    deleted: Column | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """The events' columns with eff_start_date, eff_end_date and is_current: disjoint
    periods, the last of a key open.

    ``events`` has one row per key and day. An event that changes no
    ``tracked`` column (null-safe) prolongs the period before it. ``deleted``
    ends a period without beginning one. Events without a day are left out. A
    key with any number of events is spread over blocks.
    """
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    dated = events.filter(F.col(day).isNotNull()).withColumn("_gone", gone)
    state = [*tracked, "_gone"]
    before = {f"_old_{c}": F.col(c) for c in state}
    compared = neighbours(dated, keys, [day], before={**before, "_known": F.lit(True)}, block_rows=block_rows)
    same = F.coalesce(F.col("_known"), F.lit(False))
    for name in state:
        same = same & F.col(name).eqNullSafe(F.col(f"_old_{name}"))
    changed = materialize(compared.filter(~same).drop("_known", *before), "changes")
    followed = neighbours(changed, keys, [day], after={"_next": F.col(day)}, block_rows=block_rows)
    return followed.filter(~F.col("_gone")).select(
        *events.columns,
        F.col(day).cast("date").alias("eff_start_date"),
        F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END).cast("date")).alias("eff_end_date"),
        F.col("_next").isNull().alias("is_current"),
    )


def apply_changes(
    events: DataFrame,
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    tracked: Sequence[str],
    deleted: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Events and history after a load of ``changes``, old and new days mixed.

    Only the keys that the load names are drawn anew; the rows of all others
    are taken over as they are.
    """
    touched = materialize(changes.groupBy(*keys).agg(F.lit(True).alias("_touched")), "touched")

    def parted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = skew_join(df, touched, keys, "left", null_safe=True)
        return marked.filter("_touched").drop("_touched"), marked.filter("_touched IS NULL").drop("_touched")

    named, others = parted(events)
    merged = materialize(add_changes(named, changes, keys, day, order), "events")
    drawn = periods(merged, keys, day, tracked, deleted)
    return others.unionByName(merged), parted(history)[1].unionByName(drawn.select(*history.columns))
