"""From natural keys to surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.operators.joins import skew_join, unique_by
from sparkclaims.operators.positions import carry_last

UNMATCHED = -1


def resolve_key(
    fact: DataFrame,
    dimension: DataFrame,
    natural: str,
    surrogate: str,
    day: str | None = None,
) -> DataFrame:
    """Adds the surrogate key of ``natural``; -1 where there is none. A natural
    key with two surrogate keys raises.

    With ``day`` the dimension is a history: the row valid on that day counts,
    from ``eff_start_date`` to ``eff_end_date`` inclusive. The periods of a key
    are disjoint, so no fact row is repeated.
    """
    residual = None
    if day is None:
        slim = unique_by(dimension.select(natural, F.col(surrogate).alias("_key")), [natural])
    else:
        slim = dimension.select(
            natural,
            F.col(surrogate).alias("_key"),
            F.col("eff_start_date").alias("_from"),
            F.col("eff_end_date").alias("_upto"),
        )
        residual = F.col(day).between(F.col("_from"), F.col("_upto"))
    joined = skew_join(fact, slim, [natural], "left", residual=residual)
    return joined.select(
        *fact.columns, F.coalesce("_key", F.lit(UNMATCHED)).cast("long").alias(surrogate)
    )


def resolve_key_as_of(
    fact: DataFrame, dimension: DataFrame, natural: str, surrogate: str, day: str, block_rows: int | None = None
) -> DataFrame:
    """Adds the surrogate key that ``natural`` had on ``day``; -1 where there is none.

    The same as ``resolve_key`` with a day, without a row per fact and version:
    facts and period starts are put in one order of key and day, and each fact
    takes the last period that began. It is valid up to ``eff_end_date``
    inclusive. A key may have any number of versions, and a third of the facts.
    Two periods of a key that begin on one day raise; a period without a start
    or a key is never valid, nor is any for a fact without them.
    """
    starts = unique_by(
        dimension.filter(F.col(natural).isNotNull() & F.col("eff_start_date").isNotNull()).select(
            natural, F.col("eff_start_date").alias("_day"), F.col(surrogate).alias("_key"), F.col("eff_end_date").alias("_upto")
        ),
        [natural, "_day"],
    )
    period = F.struct(F.col("_key").cast("long").alias("key"), F.col("_upto").cast("date").alias("upto"))
    events = starts.select(natural, F.col("_day").cast("date").alias("_day"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), period.alias("_period"))
    rows = F.struct(*[F.col(c) for c in fact.columns])
    # The tie spreads the facts of one key and day over partitions.
    facts = fact.select(
        natural, F.col(day).cast("date").alias("_day"), F.lit(1).alias("_kind"),
        F.monotonically_increasing_id().alias("_tie"), rows.alias("_row"),
    )
    both = events.unionByName(facts, allowMissingColumns=True)
    carried = carry_last(both, [natural], ["_day", "_kind", "_tie"], F.col("_period"), "_found", block_rows)
    valid = F.col(natural).isNotNull() & (F.col("_day") <= F.col("_found.upto"))
    return carried.filter(F.col("_kind") == 1).select(
        "_row.*", F.when(valid, F.coalesce("_found.key", F.lit(UNMATCHED))).otherwise(UNMATCHED).cast("long").alias(surrogate)
    )
