"""Ordered operators over whole tables or hot groups.

A window without a partition key, or with a key that a third of the rows
share, runs in one task. The operators here sort the rows with a range
partitioning instead, whose keys include the caller's tie-breaking columns, so
that the partitions are balanced whatever the group sizes. The sorted rows are
written once to the shared folder. Everything that crosses partitions is then
a table with a few rows per partition, small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.functions.columns import rounded_ratio
from sparkclaims.operators.joins import join_null_safe, skew_join
from sparkclaims.storage import materialize

BLOCK, INDEX = "_block", "_index"
# Fixed value: monotonically_increasing_id keeps the row number in 33 bits.
_INDEX_BITS = 33
# Rows of a sorted partition, on the average, and of a block; their numbers follow from the rows.
PARTITION_ROWS = 4_000_000
BLOCK_ROWS = 65_536
# Blocks of one partition are numbered in so many bits.
_BLOCK_BITS = 24


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def ordered_blocks(
    df: DataFrame,
    order: Sequence[str | Column],
    block_rows: int | None = None,
    partition_rows: int | None = None,
) -> DataFrame:
    """Rows in global order: ``_block`` numbers runs of up to ``block_rows``
    consecutive rows and ``_index`` the rows of each. ``order`` must identify a row.

    The rows are counted, and sorted in partitions of about ``partition_rows``:
    as many as that takes, and no fewer than the session's shuffle partitions
    while they hold a block each. ``df`` is run three times, to count, to
    sample and to sort: hand in a written table when it is a join.
    """
    keys = _columns(order)
    block_rows = block_rows or BLOCK_ROWS
    rows = df.count()
    wished = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(1, -(-rows // (partition_rows or PARTITION_ROWS)), min(wished, -(-rows // block_rows)))
    ordered = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    table = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered", compression="zstd")
    index = F.col("_id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    partition = F.shiftright("_id", _INDEX_BITS)
    return table.select(
        *df.columns,
        (F.shiftleft(partition, _BLOCK_BITS) + F.floor(index / block_rows)).alias(BLOCK),
        (index % block_rows).alias(INDEX),
    )


def _with_start(blocks: DataFrame) -> DataFrame:
    """Adds ``_position`` (1-based, global) and ``_total`` (rows in all).

    The windows see one row per block: first those of a partition, then one
    row per partition.
    """
    part = F.shiftright(BLOCK, _BLOCK_BITS)
    counts = materialize(blocks.groupBy(BLOCK).agg(F.count("*").alias("_rows")).withColumn("_part", part), "blocks")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = counts.groupBy("_part").agg(F.sum("_rows").alias("_rows")).select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_part_start"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    within = Window.partitionBy("_part").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        BLOCK, "_part", F.coalesce(F.sum("_rows").over(within), F.lit(0)).alias("_block_start")
    ).join(parts, "_part")
    written = materialize(
        starts.select(BLOCK, (F.col("_part_start") + F.col("_block_start")).alias("_start"), "_total"), "starts"
    )
    # One row per block on the right; Catalyst broadcasts the table when it is small.
    return blocks.join(written, BLOCK).withColumn("_position", F.col("_start") + F.col(INDEX) + 1)


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Adds the surrogate key 1..n in the given order."""
    return _with_start(ordered_blocks(df, order)).select(
        F.col("_position").alias(name), *df.columns
    )


def global_ntile(df: DataFrame, tiles: int, order: Sequence[str | Column], name: str) -> DataFrame:
    """NTILE over all rows; the first ``n mod tiles`` tiles hold one row more."""
    row = F.col("_position") - 1
    size = F.floor(F.col("_total") / tiles)
    extra = F.col("_total") % tiles
    in_large = extra * (size + 1)
    tile = F.when(row < in_large, F.floor(row / (size + 1)) + 1).otherwise(
        extra + F.floor((row - in_large) / F.nullif(size, F.lit(0))) + 1
    )
    return _with_start(ordered_blocks(df, order)).select(
        *df.columns, tile.cast("int").alias(name)
    )


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, Column],
    block_rows: int | None = None,
) -> DataFrame:
    """Adds, per group, the sums from its first row to the current one.

    Each block sums its own rows; a group that began in an earlier block gets
    that part added. At most one group per block does.
    """
    inputs = {f"_in_{name}": value for name, value in sums.items()}
    blocks = ordered_blocks(df.withColumns(inputs), [*group, *order], block_rows)
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy(BLOCK, *group)
        .agg(*[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in sums])
        .select(
            BLOCK,
            *group,
            F.count("*").over(earlier).alias("_blocks"),
            *[F.sum(f"_sum_{name}").over(earlier).alias(f"_from_{name}") for name in sums],
        )
        .filter(F.col("_blocks") > 0)
        .drop("_blocks")
    )
    local = Window.partitionBy(BLOCK, *group).orderBy(INDEX).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = blocks.withColumns(
        {f"_local_{name}": F.sum(f"_in_{name}").over(local) for name in sums}
    )
    # At most one row per block; Catalyst broadcasts the table when it is small.
    joined = join_null_safe(inside, materialize(carried, "carried"), [BLOCK, *group], "left")
    return joined.select(
        *df.columns,
        *[_add(F.col(f"_local_{name}"), F.col(f"_from_{name}")).alias(name) for name in sums],
    )


def _add(left: Column, right: Column) -> Column:
    """Sum in which a null counts as nothing, and null if both are."""
    return F.when(left.isNull(), right).otherwise(F.coalesce(left + right, left))


def neighbours(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Adds, per group, values of the row before (``before``) and of the row after
    (``after``); null where the group has no such row.

    Within a block they come from a window, at a block's edge from a table
    with one row per block and group. At most two groups per block have one.
    """
    before, after = before or {}, after or {}
    # A struct, so that a null value is not taken for a missing row.
    given = {"_before": F.struct(F.lit(True), *[v.alias(n) for n, v in before.items()]),
             "_after": F.struct(F.lit(True), *[v.alias(n) for n, v in after.items()])}
    blocks = ordered_blocks(df.withColumns(given), [*group, *order], block_rows)
    local = Window.partitionBy(BLOCK, *group).orderBy(INDEX)
    inside = blocks.withColumns({"_lag": F.lag("_before").over(local), "_lead": F.lead("_after").over(local)})
    across = Window.partitionBy(*group).orderBy(BLOCK)
    edges = (
        blocks.groupBy(BLOCK, *group)
        .agg(F.max_by("_before", INDEX).alias("_last"), F.min_by("_after", INDEX).alias("_first"))
        .select(BLOCK, *group, F.lag("_last").over(across).alias("_edge_lag"), F.lead("_first").over(across).alias("_edge_lead"))
        .filter(F.col("_edge_lag").isNotNull() | F.col("_edge_lead").isNotNull())
    )
    joined = join_null_safe(inside, materialize(edges, "edges"), [BLOCK, *group], "left")
    lag, lead = F.coalesce("_lag", "_edge_lag"), F.coalesce("_lead", "_edge_lead")
    return joined.select(
        *df.columns, *[lag[n].alias(n) for n in before], *[lead[n].alias(n) for n in after]
    )


def carry_last(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: Column, name: str, block_rows: int | None = None
) -> DataFrame:
    """Adds, per group, the last ``value`` that is not null up to the current row.

    What earlier blocks of the group bring is one row per block and group.
    """
    blocks = ordered_blocks(df.withColumn("_value", value), [*group, *order], block_rows)
    local = Window.partitionBy(BLOCK, *group).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = blocks.withColumn("_local", F.last("_value", ignorenulls=True).over(local))
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = F.when(F.col("_value").isNotNull(), F.col(INDEX))
    carried = (
        blocks.groupBy(BLOCK, *group)
        .agg(F.max_by("_value", placed).alias("_last"))
        .select(BLOCK, *group, F.last("_last", ignorenulls=True).over(earlier).alias("_earlier"))
        .filter(F.col("_earlier").isNotNull())
    )
    joined = join_null_safe(inside, materialize(carried, "carried"), [BLOCK, *group], "left")
    return joined.select(*df.columns, F.coalesce("_local", "_earlier").alias(name))


def moving_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, Column],
    before: int,
    after: int,
    tile_rows: int = 65_536,
) -> DataFrame:
    """Adds sums over ``before`` rows back to ``after`` rows ahead in the group.

    Rows are cut in tiles of consecutive positions; the few rows near an edge
    are copied to the neighbouring tile, which makes every frame complete.
    """
    if tile_rows < max(before, after, 1):
        raise ValueError("a tile must hold at least one frame side")
    # What is summed follows from the rows, so it need not be sorted with them.
    inputs = {f"_in_{name}": value for name, value in sums.items()}
    placed = _with_start(ordered_blocks(df, [*group, *order])).withColumns(inputs)
    row = F.col("_position") - 1
    home = F.floor(row / tile_rows)
    offset = row % tile_rows
    copies = F.array_compact(
        F.array(
            home,
            F.when((offset < after) & (home > 0), home - 1),
            F.when(offset >= tile_rows - before, home + 1),
        )
    )
    frame = Window.partitionBy("_tile", *group).orderBy("_position").rowsBetween(-before, after)
    return (
        placed.withColumn("_home", home)
        .withColumn("_tile", F.explode(copies))
        .withColumns({f"_out_{name}": F.sum(f"_in_{name}").over(frame) for name in sums})
        .filter(F.col("_tile") == F.col("_home"))
        .select(*df.columns, *[F.col(f"_out_{name}").alias(name) for name in sums])
    )


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``_count`` per group and value, written once.

    Equal rows collapse before the shuffle, so a hot value or group costs one
    row per task.
    """
    return materialize(
        df.groupBy(*group, value).agg(F.count("*").alias("_count")), "value_counts"
    )


def cumulative_counts(counts: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Adds ``_upto``: the rows of the group with a value up to this one."""
    return running_sums(counts, group, [value], {"_upto": F.col("_count")})


def group_totals(counts: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Rows per group, written so that Catalyst knows the size of the table."""
    return materialize(counts.groupBy(*group).agg(F.sum("_count").alias(name)), "totals")


def percent_rank(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    name: str,
    digits: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds PERCENT_RANK of ``value`` in the group, ascending, nulls first; with
    ``digits`` as a percentage rounded to that many places.

    The rank of a row follows from counts per distinct value; the rows
    themselves are neither sorted nor, for a small table of values, shuffled.
    ``counted`` has the same rows where ``df`` is costly to run.
    """
    counts = value_counts(df if counted is None else counted, group, value)
    ranked = cumulative_counts(counts, group, value)
    totals = group_totals(counts, group, "_n")
    below, others = F.col("_upto") - F.col("_count"), F.col("_n") - 1
    if digits is None:
        share = F.try_divide(below.cast("double"), others.cast("double"))
    else:
        share = rounded_ratio(below * 100, others, digits)
    keys = [*group, value]
    # A row alone in its group has rank 0.
    shares = materialize(
        join_null_safe(ranked, totals, group, "inner").select(*keys, F.coalesce(share, F.lit(0)).alias(name)), "shares"
    )
    frequencies = counts.withColumnRenamed("_count", "_rows")
    return skew_join(df, shares, keys, "inner", null_safe=True, frequencies=lambda: frequencies)
