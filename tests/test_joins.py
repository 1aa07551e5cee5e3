from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import joins
from sparkclaims.operators.joins import (
    Dimension,
    fits_broadcast,
    hot_keys,
    skew_join,
    star_aggregate,
    unique_by,
)
from sparkclaims.operators.keys import resolve_key


@pytest.fixture
def fact(spark):
    """900 rows; a third has key 7, some have no key or an unknown one."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 40)
    return spark.range(900).select("id", key.cast("int").alias("k"))


@pytest.fixture
def table(spark):
    return spark.range(30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("x"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain(fact, table, no_broadcast, rows, how):
    plain = fact.join(table, "k", how)
    salted = skew_join(fact, table, ["k"], how, hot_rows=50, may_broadcast=False)
    assert rows(salted, "id", "k", "x") == rows(plain, "id", "k", "x")


def test_salted_null_safe_join(fact, table, spark, no_broadcast, rows):
    right = table.unionByName(spark.createDataFrame([(None, -1)], "k int, x bigint"))
    got = skew_join(fact, right, ["k"], "inner", null_safe=True, hot_rows=10, may_broadcast=False)
    assert got.filter("k IS NULL").select("x").distinct().collect()[0][0] == -1
    assert got.count() == fact.filter("k IS NULL OR k < 30").count()


def test_hot_rows_are_spread(fact, table, no_broadcast):
    salted = skew_join(fact, table, ["k"], "left", hot_rows=50, may_broadcast=False)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    counted = fact.groupBy("k").agg(F.count("*").alias("_rows"))
    # 300 rows of key 7, and those without a key, which match nothing but share a task.
    assert {r["k"]: r["_salts"] for r in hot_keys(counted, ["k"], 50).collect()}.keys() == {7, None}


def test_residual_condition(fact, spark, no_broadcast, rows):
    right = spark.createDataFrame([(7, 0, 449, "early"), (7, 450, 900, "late")], "k int, lo int, hi int, w string")
    within = F.col("id").between(F.col("lo"), F.col("hi"))
    got = skew_join(fact, right, ["k"], "left", residual=within, hot_rows=50, may_broadcast=False)
    assert got.count() == 900
    assert got.filter("k = 7 AND w IS NULL").count() == 0
    assert got.filter("w = 'early' AND id >= 450").count() == 0


@pytest.mark.parametrize("shuffles", ["2", "8"])
def test_no_task_gets_more_rows_of_a_key_than_the_target(spark, no_broadcast, shuffles):
    """1,500 hot keys, and one that has a third of the rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        wide = spark.range(30_000).select("id", (F.col("id") % 1500).alias("k")).union(
            spark.range(15_000).select("id", F.lit(-1).cast("long").alias("k"))
        )
        counted = wide.groupBy("k").agg(F.count("*").alias("_rows"))
        hot = {r["k"]: r["_salts"] for r in hot_keys(counted, ["k"], 10).collect()}
        assert len(hot) == 1501 and hot[-1] == 1500 and hot[3] == 2
        right = spark.range(-1, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
        got = skew_join(wide, right, ["k"], "inner", hot_rows=10, may_broadcast=False)
        assert got.count() == 45_000 and got.filter("x <> 2 * k").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_only_left_and_inner(fact, table):
    with pytest.raises(ValueError):
        skew_join(fact, table, ["k"], "full")


def test_unique_by(spark, rows):
    good = spark.createDataFrame([(1, "a", None), (None, "b", 2)], "k int, v string, n int")
    assert rows(unique_by(good, ["k"])) == rows(good)
    assert rows(unique_by(good.select("k"), ["k"])) == [(None,), (1,)]
    bad = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        unique_by(bad, ["k"]).collect()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_star_aggregate_with_and_without_broadcast(fact, table, spark, rows, how):
    names = spark.range(60).select(F.col("id").alias("x"), (F.col("id") % 4).cast("string").alias("name"))
    dims = [Dimension(table, "k", ["x"], how), Dimension(names, "x", ["name"], how)]
    sums = {"n": F.lit(1).cast("long"), "total": F.col("id")}
    expected = (
        fact.join(table, "k", how).join(names, "x", how).groupBy("name")
        .agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    )
    assert rows(star_aggregate(fact, dims, ["name"], sums)) == rows(expected)


def test_star_aggregate_reduces_before_a_large_join(fact, table, no_broadcast, rows):
    assert not fits_broadcast(table)
    sums = {"n": F.lit(1).cast("long")}
    got = star_aggregate(fact, [Dimension(table, "k", ["x"])], ["x"], sums)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert "Aggregate [k" in plan[join:]
    assert rows(got) == rows(fact.join(table, "k").groupBy("x").agg(F.count("*").alias("n")))


def test_star_aggregate_salts_a_fact_that_carries_more(fact, table, no_broadcast, monkeypatch, rows):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    wide = fact.withColumn("kind", F.col("id") % 5)
    sums = {"n": F.lit(1).cast("long")}
    got = star_aggregate(wide, [Dimension(table, "k", ["x"])], ["x", "kind"], sums)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    expected = wide.join(table, "k").groupBy("x", "kind").agg(F.count("*").alias("n"))
    assert rows(got) == rows(expected)


def test_resolve_key(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    dim = spark.createDataFrame([("a", 10)], "c string, key int")
    assert rows(resolve_key(fact, dim, "c", "key"), "id", "key") == [(1, 10), (2, -1), (3, -1)]
    with pytest.raises(Exception, match="duplicate key"):
        resolve_key(fact, dim.union(dim), "c", "key").collect()


def test_resolve_key_in_a_history(spark, rows):
    dim = spark.createDataFrame(
        [("a", 1, "2020-01-01", "2021-06-30"), ("a", 2, "2021-07-01", "9999-12-31")],
        "c string, key int, f string, u string",
    ).select("c", "key", F.to_date("f").alias("eff_start_date"), F.to_date("u").alias("eff_end_date"))
    fact = spark.createDataFrame(
        [(1, "a", "2019-12-31"), (2, "a", "2021-06-30"), (3, "a", "2021-07-01"), (4, "b", "2021-07-01")],
        "id int, c string, d string",
    ).withColumn("d", F.to_date("d"))
    assert rows(resolve_key(fact, dim, "c", "key", "d"), "id", "key") == [(1, -1), (2, 1), (3, 2), (4, -1)]


def test_a_small_aggregate_of_a_large_table_needs_no_shuffle_of_the_fact(spark, rows, monkeypatch):
    """Catalyst's bound on the groups is the size of the whole table."""
    kinds = spark.range(5_000_000).groupBy((F.col("id") % 5).alias("k")).agg(F.min("id").alias("x"))
    assert not fits_broadcast(kinds)
    monkeypatch.setattr(joins, "skew_join", None)
    fact = spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") % 2).alias("kind"))
    got = star_aggregate(fact, [Dimension(kinds, "k", ["x"])], ["x", "kind"], {"n": F.lit(1).cast("long")})
    assert sum(r["n"] for r in got.collect()) == sum(1 for i in range(100) if i % 7 < 5)


def test_claims_meet_the_policies_only(spark, no_broadcast, monkeypatch):
    from sparkclaims.plans import star

    claims = spark.createDataFrame([("c1", 1, 9), ("c2", 2, None), ("c3", None, 8), ("c4", 5, 9)], "claim_id string, policy_id long, agent_id long")
    people = ", ".join(f"{n} string" for n in ["age_band", "income_band", "credit_band", "gender", "city", "state"])
    tables = star.ClaimStar(
        claims,
        spark.createDataFrame([(1, 4, "t"), (2, None, "u")], "policy_id long, customer_id long, policy_type_id string"),
        spark.createDataFrame([(4, "a", "i", "c", "g", "p", "s")], f"customer_id long, {people}"),
        spark.createDataFrame([("t", "T", "Fast")], "policy_type_id string, policy_type_name string, category string"),
        spark.createDataFrame([(9, "west")], "agent_id long, region string"),
        None,
    )
    seen, plain = [], star.skew_join

    def noted(left, right, keys, *args, **options):
        seen.append(("claim_id" in left.columns, *keys))
        return plain(left, right, keys, *args, **options)

    monkeypatch.setattr(star, "skew_join", noted)
    got = sorted(tuple(r) for r in star.denormalize(tables).select("claim_id", "policy_type_name", "region", "city").collect())
    assert got == [("c1", "T", "west", "p"), ("c2", None, None, None), ("c3", None, None, None), ("c4", None, "west", None)]
    assert sorted(s[1] for s in seen if s[0]) == ["agent_id", "policy_id"]
