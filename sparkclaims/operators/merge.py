"""Upserts and history as joins that produce the next snapshot of a table."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.functions.columns import OPEN_END
from sparkclaims.operators.joins import unique_by


def merge_scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    changed: tuple[str, str],
    insert: Mapping[str, str],
    stamps: Mapping[str, Column],
) -> DataFrame:
    """The target after an upsert.

    ``changed`` names a target and a source column; a matched row takes the
    source value and the ``stamps`` only when the two differ (null differs from
    nothing). ``insert`` maps target columns to source columns for unmatched
    source rows, whose other columns are null. A repeated source key raises.
    """
    target_column, source_column = changed
    used = [*keys, *sorted({source_column, *insert.values()} - {*keys})]
    incoming = unique_by(source.select(*used), keys).withColumnsRenamed(
        {name: f"_new_{name}" for name in used}
    ).withColumn("_in_source", F.lit(True))
    current = target.withColumn("_in_target", F.lit(True))
    matched = [current[k] == incoming[f"_new_{k}"] for k in keys]
    both = current.join(incoming, matched, "full_outer")
    absent = F.col("_in_target").isNull()
    update = F.coalesce(F.col(target_column) != F.col(f"_new_{source_column}"), F.lit(False))

    def column(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(name), F.col(f"_new_{name}")).alias(name)
        kept = F.col(name)
        if name == target_column:
            kept = F.when(update, F.col(f"_new_{source_column}")).otherwise(kept)
        elif name in stamps:
            kept = F.when(update, stamps[name]).otherwise(kept)
        if name in stamps:
            added = stamps[name]
        elif name in insert:
            added = F.col(f"_new_{insert[name]}")
        else:
            added = F.lit(None)
        return F.when(absent, added).otherwise(kept).alias(name)

    return both.select(*[column(name) for name in target.columns])


def initial_history(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """The first load of a history table: one open row per key."""
    return df.withColumns(
        {
            "eff_start_date": F.lit(as_of),
            "eff_end_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
            "last_updated": F.lit(as_of).cast("timestamp"),
        }
    )


def merge_scd2(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: datetime.date,
) -> DataFrame:
    """The history after loading ``source`` on ``as_of``.

    A current row whose tracked columns differ (null-safe) is closed the day
    before, and the source row is appended. A second change on one day replaces
    the open row. Keys missing from the source stay open.
    """
    day = F.lit(as_of)
    state = ["eff_start_date", "eff_end_date", "is_current", "last_updated"]
    values = [c for c in source.columns if c not in keys]
    opened = {
        "eff_start_date": day,
        "eff_end_date": F.lit(OPEN_END),
        "is_current": F.lit(True),
        "last_updated": day.cast("timestamp"),
    }
    incoming = unique_by(source, keys).select(
        *[F.col(k).alias(f"_new_{k}") for k in keys],
        F.struct(*values).alias("_new"),
        F.lit(True).alias("_in_source"),
    )
    closed = history.filter(~F.col("is_current"))
    current = history.filter(F.col("is_current")).withColumn("_in_target", F.lit(True))
    both = current.join(
        incoming, [current[k] == incoming[f"_new_{k}"] for k in keys], "full_outer"
    )
    differs = F.lit(False)
    for name in tracked:
        differs = differs | ~F.col(name).eqNullSafe(F.col("_new")[name])
    is_new = F.col("_in_target").isNull()
    is_changed = ~is_new & F.col("_in_source").isNotNull() & differs
    same_day = F.col("eff_start_date") == day

    names = history.columns

    def old_value(name: str) -> Column:
        if name == "eff_end_date":
            return F.when(is_changed, F.date_sub(day, 1)).otherwise(F.col(name))
        if name == "is_current":
            return ~is_changed
        if name == "last_updated":
            return F.when(is_changed, day.cast("timestamp")).otherwise(F.col(name))
        return F.col(name)

    def new_value(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(name), F.col(f"_new_{name}"))
        if name in state:
            return opened[name]
        return F.col("_new")[name] if name in values else F.lit(None)

    def row(value) -> Column:
        return F.struct(
            *[value(n).cast(history.schema[n].dataType).alias(n) for n in names]
        )

    kept = F.when(~is_new & ~(is_changed & same_day), row(old_value))
    added = F.when(is_new | is_changed, row(new_value))
    return closed.unionByName(
        both.select(F.explode(F.array_compact(F.array(kept, added))).alias("_row")).select("_row.*")
    )
