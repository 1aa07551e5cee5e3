"""Quantile sketches in summaries, and membership filters across loads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkclaims.functions.columns import padded_id
from sparkclaims.operators import sketches, summary
from sparkclaims.operators.distribution import exact_quantiles
from sparkclaims.operators.membership import MembershipFilter, buckets_for, false_share, repeats_across_loads

SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


def summarised(rows):
    return rows.groupBy("g").agg(F.count("*").alias("n"), sketches.sketch(F.col("v")).alias("s"))


@pytest.fixture
def values(spark):
    """A hot group of skewed values, one of ties and one of a single row."""
    return spark.range(60_000).selectExpr(
        "CASE WHEN id = 0 THEN 'one' WHEN id % 3 = 0 THEN 'ties' ELSE 'hot' END AS g",
        "CASE WHEN id % 3 = 0 THEN CAST(id % 4 AS DOUBLE) ELSE exp(CAST(pmod(xxhash64(id), 1000) AS DOUBLE) / 100) END AS v",
    )


def test_refreshed_sketches_stay_within_their_bound(spark, values, tmp_path):
    base = str(tmp_path / "s")
    parts = [values.filter(F.pmod(F.xxhash64("v", "g"), F.lit(5)) == k) for k in range(5)]
    for batch, part in enumerate([*parts, parts[-1]]):
        summary.refresh_batch(spark, base, min(batch, 4), summarised(part), ["g"], ["n"], ["s"])
    latest = summary.latest_summary(spark, base)
    assert {r["g"]: r["n"] for r in latest.collect()} == {"one": 1, "ties": 19_999, "hot": 40_000}
    errors = sketches.rank_errors(values, latest, "g", "v", "s", SHARES).collect()
    assert len(errors) == 15 and all(r["error"] <= 2 * sketches.rank_error() for r in errors)


def test_few_rows_are_exact(spark):
    rows = spark.createDataFrame([("a", float(k)) for k in range(101)] + [("b", None)], "g string, v double")
    found = {r["g"]: r["q"] for r in summarised(rows).select("g", sketches.quantiles("s", [0.0, 0.5, 1.0]).alias("q")).collect()}
    assert found["a"] == [0.0, 50.0, 100.0] and found["b"] is None
    exact = exact_quantiles(rows, ["g"], "v", {"q": 0.5})
    assert [(r["g"], r["q"]) for r in exact.collect() if r["q"] is not None] == [("a", 50.0)]


def test_the_bound_shrinks_with_the_size():
    assert 0.004 < sketches.rank_error(800) < 0.006 < sketches.rank_error(200)


KEYS = ("k", "part")


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, part int")


@pytest.fixture
def loaded(spark):
    rng = random.Random(2)
    rows = [(f"key{n}", rng.choice([1, 2])) for n in range(3_000)] + [("hot", 1)] * 900 + [(None, 1), ("x", None), (None, None)]
    return table(spark, rows)


@pytest.fixture
def known(spark, loaded, tmp_path):
    made = MembershipFilter(str(tmp_path / "filter"), KEYS, buckets_for(3_004))
    made.add(loaded.filter("part = 1"))
    made.add(loaded.filter("part = 2 OR part IS NULL"))
    made.add(loaded.filter("part = 2"))
    return made


def test_every_loaded_key_passes_and_few_others(spark, loaded, known):
    assert known.passing(loaded.distinct()).count() == loaded.distinct().count()
    others = spark.range(20_000).selectExpr("concat('other', id) AS k", "1 AS part")
    share = known.passing(others).count() / 20_000
    expected = false_share(3_004, known.buckets)
    assert expected < 0.02 and share < 2 * expected + 0.01


def test_repeats_are_exact(spark, loaded, known, rows):
    incoming = table(spark, [("key5", 1), ("key5", 2), ("hot", 1), ("hot", 1), ("hot", 2), (None, 1), (None, 2), ("x", None), (None, None), ("new", 1)] + [(f"other{n}", 1) for n in range(2_000)])
    held = {}
    for r in loaded.collect():
        held[tuple(r)] = held.get(tuple(r), 0) + 1
    want = {}
    for r in incoming.collect():
        if tuple(r) in held:
            want[tuple(r)] = want.get(tuple(r), 0) + 1
    got = {(r["k"], r["part"]): (r["rows"], r["rows_loaded"]) for r in repeats_across_loads(incoming, loaded, known).collect()}
    assert got == {key: (n, held[key]) for key, n in want.items()} and ("hot", 1) in got and (None, None) in got


def test_the_large_side_is_scanned_once(spark, loaded, known, tmp_path):
    path = str(tmp_path / "loaded")
    loaded.withColumn("payload", F.lit("wide")).write.parquet(path)
    plan = repeats_across_loads(table(spark, [("key1", 1)]), spark.read.parquet(path), known)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "payload" not in line and "tests" not in line and path in line]
    assert len(scans) == 1


def test_loads_of_nothing(spark, loaded, known):
    assert repeats_across_loads(loaded.limit(0), loaded, known).count() == 0
    assert buckets_for(0) == 1 and known.passing(loaded.limit(0)).count() == 0


def test_long_ids_keep_their_digits(spark):
    row = spark.range(1).select(padded_id("C", F.lit(42), 6), padded_id("C", F.lit(12_345_678), 6), padded_id("C", F.lit(None).cast("int"), 6)).first()
    assert tuple(row) == ("C000042", "C12345678", None)
