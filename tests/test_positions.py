from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import positions


pytestmark = pytest.mark.usefixtures("many_blocks")

def sample(spark, n, seed=3):
    """Rows of which a third share one group and one value; some keys are null."""
    draw = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else draw.choice(["a", "b", None])
        value = 5 if i % 3 == 1 else draw.choice([None, 1, 2, 3, 7, 9])
        data.append((i, group, value, draw.randrange(100)))
    df = spark.createDataFrame(data, "id int, g string, v int, m int").repartition(5)
    return data, df


def nulls_first(value):
    return (value is not None, value if value is not None else 0)


@pytest.mark.parametrize("n", [0, 1, 3, 100, 1001])
def test_dense_key(spark, n):
    data, df = sample(spark, n)
    got = {r["id"]: r["k"] for r in positions.dense_key(df, ["v", "id"], "k").collect()}
    ordered = sorted(data, key=lambda r: (nulls_first(r[2]), r[0]))
    assert got == {row[0]: i for i, row in enumerate(ordered, 1)}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 1001])
def test_global_ntile(spark, n):
    data, df = sample(spark, n)
    order = [F.desc_nulls_first("v"), "id"]
    got = {r["id"]: r["t"] for r in positions.global_ntile(df, 4, order, "t").collect()}
    ordered = sorted(data, key=lambda r: ((r[2] is not None), -(r[2] or 0), r[0]))
    size, extra = divmod(n, 4)
    tiles = [t for t in range(4) for _ in range(size + (t < extra))]
    assert got == {row[0]: tile + 1 for row, tile in zip(ordered, tiles)}
    counts = [list(got.values()).count(t) for t in set(got.values())]
    assert not counts or max(counts) - min(counts) <= 1


def by_group(data, key):
    groups = {}
    for row in sorted(data, key=key):
        groups.setdefault(row[1], []).append(row)
    return groups


@pytest.mark.parametrize("n, block_rows", [(0, 1), (2, 1), (500, 1), (500, 7), (500, 4096)])
def test_running_sums(spark, n, block_rows):
    data, df = sample(spark, n)
    sums = {"total": F.col("m"), "known": F.col("v").cast("long")}
    got = {r["id"]: (r["total"], r["known"]) for r in positions.running_sums(df, ["g"], ["v", "id"], sums, block_rows).collect()}
    expected = {}
    for rows in by_group(data, lambda r: (nulls_first(r[2]), r[0])).values():
        total, known = 0, None
        for row in rows:
            total += row[3]
            if row[2] is not None:
                known = (known or 0) + row[2]
            expected[row[0]] = (total, known)
    assert got == expected


@pytest.mark.parametrize("tile_rows", [3, 7, 1000])
def test_moving_sums(spark, tile_rows):
    data, df = sample(spark, 300)
    moved = positions.moving_sums(df, ["g"], ["v", "id"], {"s": F.col("m")}, 3, 2, tile_rows)
    got = {r["id"]: r["s"] for r in moved.collect()}
    expected = {}
    for rows in by_group(data, lambda r: (nulls_first(r[2]), r[0])).values():
        for i, row in enumerate(rows):
            expected[row[0]] = sum(r[3] for r in rows[max(0, i - 3): i + 3])
    assert got == expected
    with pytest.raises(ValueError):
        positions.moving_sums(df, ["g"], ["id"], {"s": F.col("m")}, 3, 3, tile_rows=2)


def test_percent_rank(spark, no_broadcast):
    data, df = sample(spark, 400)
    ranked = positions.percent_rank(df, ["g"], "v", "p")
    got = {r["id"]: r["p"] for r in ranked.collect()}
    expected = {}
    for rows in by_group(data, lambda r: r[0]).values():
        for row in rows:
            below = sum(nulls_first(r[2]) < nulls_first(row[2]) for r in rows)
            expected[row[0]] = below / (len(rows) - 1)
    assert got == pytest.approx(expected)


def test_percent_rank_of_a_single_row(spark):
    df = spark.createDataFrame([("a", 1)], "g string, v int")
    assert positions.percent_rank(df, ["g"], "v", "p").first()["p"] == 0.0
    assert positions.percent_rank(df, ["g"], "v", "p", digits=2).first()["p"] == 0


def test_hot_group_is_split(spark):
    """One group with equal values still spreads over the blocks."""
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.lit(1).alias("v"), "id").repartition(8)
    blocks = positions.ordered_blocks(df, ["g", "v", "id"], block_rows=2_000)
    sizes = [r["count"] for r in blocks.groupBy(positions.BLOCK).count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 2_000


@pytest.mark.parametrize("shuffles", ["2", "8"])
def test_partitions_follow_from_the_rows(spark, shuffles):
    """Whatever the session's shuffle partitions, none is much over the target."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        df = spark.range(40_000).select(F.lit("g").alias("g"), "id").repartition(4)
        blocks = positions.ordered_blocks(df, ["g", "id"], block_rows=500, partition_rows=2_000)
        part = F.shiftright(positions.BLOCK, 24)
        sizes = [r["count"] for r in blocks.groupBy(part).count().collect()]
        assert sum(sizes) == 40_000 and len(sizes) >= 18 and max(sizes) <= 4_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_what_is_summed_is_not_sorted_with_the_rows(spark, monkeypatch):
    written, plain = {}, positions.materialize

    def noted(df, label, **options):
        written[label] = df.columns
        return plain(df, label, **options)

    monkeypatch.setattr(positions, "materialize", noted)
    df = spark.range(10).select("id", (F.col("id") % 2).alias("g"))
    got = {r["id"]: r["s"] for r in positions.moving_sums(df, ["g"], ["id"], {"s": F.col("id")}, 1, 1).collect()}
    assert got[0] == 2 and got[4] == 2 + 4 + 6 and got[9] == 16
    assert written["ordered"] == ["id", "g", "_id"]
