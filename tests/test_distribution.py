from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import distribution
from sparkclaims.operators.grouping import cube_labelled, in_fixed_order, pivot_rate, rollup_labelled


pytestmark = pytest.mark.usefixtures("many_blocks")

@pytest.fixture
def amounts(spark):
    draw = random.Random(5)
    data = [("one", 4.0), ("flat", 2.0), ("flat", 2.0)]
    data += [("many", float(draw.randrange(1000))) for _ in range(500)]
    data += [("many", -5000.0), ("many", 9000.0), ("zeros", 0.0), ("zeros", 0.0), ("zeros", 0.0), ("zeros", 100.0)]
    df = spark.createDataFrame(data + [("many", None)], "s string, a double").repartition(4)
    groups = {}
    for s, a in data:
        groups.setdefault(s, []).append(a)
    return groups, df


@pytest.mark.parametrize("bins, sorted_rows", [(4096, 100_000), (4, 3), (2, 1)])
def test_box_stats(amounts, bins, sorted_rows):
    groups, df = amounts
    got = {r["s"]: r for r in distribution.box_stats(df, ["s"], "a", bins=bins, sorted_rows=sorted_rows).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        x = np.array(values)
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[name]
        assert r["n"] == len(x)
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, median, q3))
        assert r["whisker_low"] == pytest.approx(min(x[x >= low].min(), q1))
        assert r["whisker_high"] == pytest.approx(max(x[x <= high].max(), q3))
        assert r["outliers"] == ((x < low) | (x > high)).sum()


def test_outlier_rows(amounts, rows):
    _, df = amounts
    boxes = distribution.box_stats(df, ["s"], "a")
    assert rows(distribution.outlier_rows(df, boxes, ["s"], "a")) == [
        ("many", -5000.0), ("many", 9000.0), ("zeros", 100.0),
    ]


def test_exact_quantiles(amounts):
    groups, df = amounts
    got = distribution.exact_quantiles(df, ["s"], "a", {"p10": 0.1, "p99": 0.99}).collect()
    for r in got:
        assert (r["p10"], r["p99"]) == pytest.approx(tuple(np.percentile(groups[r["s"]], [10, 99])))


def test_histogram(amounts):
    groups, df = amounts
    got = distribution.density_histogram(df, "s", "a", 25)
    for name, values in groups.items():
        counts, edges = np.histogram(values, bins=25)
        density, _ = np.histogram(values, bins=25, density=True)
        mine = got.filter(F.col("s") == name).orderBy("bin").collect()
        assert [r["bin_count"] for r in mine] == counts.tolist()
        assert [r["density"] for r in mine] == pytest.approx(density.tolist())
        assert [r["bin_low"] for r in mine] == pytest.approx(edges[:-1].tolist())


@pytest.fixture
def grains(spark):
    return spark.createDataFrame(
        [("N", "x", 1), ("N", None, 2), (None, "x", 4), ("S", "y", 8)], "r string, p string, n bigint"
    )


LABELS = {"r": "ALL R", "p": "ALL P"}


def test_rollup_keeps_null_groups_apart(grains, rows):
    got = rows(rollup_labelled(grains, ["r", "p"], LABELS, ["n"]), "grouping_id", "r", "p", "n")
    assert got == [
        (0, None, "x", 4), (0, "N", None, 2), (0, "N", "x", 1), (0, "S", "y", 8),
        (1, None, "ALL P", 4), (1, "N", "ALL P", 3), (1, "S", "ALL P", 8), (3, "ALL R", "ALL P", 15),
    ]


def test_cube_contains_rollup(grains, rows):
    cube = cube_labelled(grains, ["r", "p"], LABELS, ["n"])
    rollup = rollup_labelled(grains, ["r", "p"], LABELS, ["n"])
    assert set(rows(rollup)) <= set(rows(cube))
    assert rows(cube.filter("grouping_id = 2"), "r", "p", "n") == [
        ("ALL R", None, 2), ("ALL R", "x", 5), ("ALL R", "y", 8),
    ]


def test_pivot_rate(spark, rows):
    grains = spark.createDataFrame(
        [("a", "x", 1, 4), ("a", "y", 0, 2), ("b", "x", 2, 2), (None, "x", 1, 1), ("b", None, 1, 1)],
        "r string, c string, f int, n int",
    )
    assert rows(pivot_rate(grains, "r", "c", ["x", "y", "z"], "f", "n")) == [
        ("a", 25.0, 0.0, 0.0), ("b", 100.0, 0.0, 0.0),
    ]


def test_fixed_order(spark):
    df = spark.createDataFrame([("b", 1), ("z", 2)], "band string, n int")
    got = [(r["band"], r["n"]) for r in in_fixed_order(df, "band", ["a", "b", "c"]).collect()]
    assert got == [("a", None), ("b", 1), ("c", None)]
