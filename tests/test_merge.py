from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import versions
from sparkclaims.operators.merge import initial_history, merge_scd1, merge_scd2
from sparkclaims.operators.paths import closure, count_paths, expand_paths
from sparkclaims.operators.summary import merge_summaries, write_summary
from sparkclaims.storage import scratch_path

DAY = datetime.date
D1, D2, D3 = DAY(2024, 1, 1), DAY(2024, 2, 1), DAY(2024, 3, 1)
OPEN = DAY(9999, 12, 31)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("a", 1, "Active", D1, "c1"), ("b", 2, "Active", D1, "c2"), ("c", 3, None, D1, "c3"), ("d", 4, "Active", D1, "c4")],
        "policy_id string, premium int, policy_status string, load_date date, customer string",
    )


def upsert(target, source):
    inserted = {"premium": "premium", "policy_status": "status"}
    return merge_scd1(
        target, source, ["policy_id"], ("policy_status", "status"), inserted, {"load_date": F.lit(D2)}
    )


def test_scd1(spark, target, rows):
    source = spark.createDataFrame(
        [("a", 9, "Active"), ("b", 9, "Lapsed"), ("c", 9, "Lapsed"), ("d", 9, None), ("e", 5, "Active")],
        "policy_id string, premium int, status string",
    )
    assert rows(upsert(target, source)) == [
        ("a", 1, "Active", D1, "c1"),   # same status
        ("b", 2, "Lapsed", D2, "c2"),   # changed
        ("c", 3, None, D1, "c3"),       # null differs from nothing
        ("d", 4, "Active", D1, "c4"),
        ("e", 5, "Active", D2, None),   # new, with the named columns only
    ]


def test_scd1_refuses_repeated_source_keys(spark, target):
    source = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "policy_id string, premium int, status string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, source).collect()


def people(spark, *data):
    return spark.createDataFrame(list(data), "id string, city string, age int")


def shown(df, rows):
    return rows(df, "id", "city", "eff_start_date", "eff_end_date", "is_current")


def test_scd2(spark, rows):
    first = initial_history(people(spark, ("a", "X", 1), ("b", None, 2), ("c", "Z", 3)), D1)
    second = merge_scd2(
        first, people(spark, ("a", "Y", 1), ("b", None, 99), ("d", "W", 4)), ["id"], ["city"], D2
    )
    assert shown(second, rows) == [
        ("a", "X", D1, DAY(2024, 1, 31), False),
        ("a", "Y", D2, OPEN, True),
        ("b", None, D1, OPEN, True),
        ("c", "Z", D1, OPEN, True),
        ("d", "W", D2, OPEN, True),
    ]
    # Null to value is a change; a second change on one day replaces the open row.
    third = merge_scd2(second, people(spark, ("b", "V", 2), ("a", "Q", 1)), ["id"], ["city"], D2)
    assert shown(third.filter("id IN ('a', 'b')"), rows) == [
        ("a", "Q", D2, OPEN, True),
        ("a", "X", D1, DAY(2024, 1, 31), False),
        ("b", None, D1, DAY(2024, 1, 31), False),
        ("b", "V", D2, OPEN, True),
    ]
    fourth = merge_scd2(third, people(spark, ("a", "R", 1)), ["id"], ["city"], D3)
    # Periods of a key are disjoint and exactly one is current.
    for key in "abcd":
        periods = sorted(r[2:] for r in shown(fourth, rows) if r[0] == key)
        assert sum(p[2] for p in periods) == 1
        assert all(a[1] < b[0] for a, b in zip(periods, periods[1:]))


def test_scd2_refuses_repeated_source_keys(spark):
    history = initial_history(people(spark, ("a", "X", 1)), D1)
    with pytest.raises(Exception, match="duplicate key"):
        merge_scd2(history, people(spark, ("a", "Y", 1), ("a", "Z", 1)), ["id"], ["city"], D2).collect()


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [("a", 10, "new", 1), ("a", 20, "changed", 2), ("a", 30, "deleted", None), ("b", 20, "new", 5), ("a", 40, "new", 7)],
        "k string, ts int, op string, v int",
    )


def test_as_of(log, rows):
    def at(ts):
        return rows(versions.as_of(log, ["k"], ["ts"], F.col("ts") <= ts, F.col("op") == "deleted"), "k", "v")

    assert at(9) == []
    assert at(10) == [("a", 1)]
    assert at(20) == [("a", 2), ("b", 5)]
    assert at(35) == [("b", 5)]
    assert at(99) == [("a", 7), ("b", 5)]
    before = versions.before_statement(log, ["k"], ["ts"], "ts", 20, F.col("op") == "deleted")
    assert rows(before, "k", "v") == [("a", 1)]


def test_offset(spark):
    times = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 01:00:00",), ("2024-01-01 01:00:01",)], "t string")
    times = times.select(F.to_timestamp("t").alias("t"))
    now = F.lit("2024-01-01 02:00:00").cast("timestamp")
    assert times.filter(versions.offset_bound("t", now, -3600)).count() == 2


def test_clone_does_not_follow_the_original(spark, log):
    base = scratch_path(spark, "snapshots")
    versions.write_snapshot(log, base, 1)
    clone = versions.read_snapshot(spark, base, 1)
    versions.write_snapshot(log.filter("k = 'b'"), base, 2)
    assert (clone.count(), versions.read_snapshot(spark, base, 2).count()) == (5, 1)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        versions.write_snapshot(log, base, 2)


def test_summaries_add_up(spark, rows):
    schema = "k string, n bigint, s decimal(20,2)"
    old = spark.createDataFrame([("a", 1, None), ("b", 2, None)], schema)
    new = spark.createDataFrame([("b", 3, None), ("c", 4, None)], schema)
    merged = merge_summaries(old, new, ["k"], ["n", "s"])
    assert rows(merged, "k", "n") == [("a", 1), ("b", 5), ("c", 4)]
    assert merged.schema["s"].dataType == old.schema["s"].dataType
    with pytest.raises(Exception, match="duplicate key"):
        write_summary(old.unionByName(old), scratch_path(spark, "summary"), 1, ["k"])


AGENTS = [("1", "r", 1), ("2", "r", 0), ("3", "r", 1), ("4", "s", 1), ("5", "t", 0), ("6", "t", 0)]


def chains():
    found = {(k, 1, k) for k, _, base in AGENTS if base}
    level = found
    region = {k: r for k, r, _ in AGENTS}
    for number in (2, 3):
        level = {
            (k, number, f"{path} -> {k}")
            for last, _, path in level
            for k in region
            if region[k] == region[last] and k != last
        }
        found = found | level
    return found


def test_expand_paths(spark):
    agents = spark.createDataFrame(AGENTS, "id string, region string, base int")
    got = expand_paths(agents, agents.filter("base = 1"), "id", "region").collect()
    assert len(got) == len(chains())
    assert {(r["id"], r["level"], r["path"]) for r in got} == chains()
    assert "1 -> 2 -> 1" in {r["path"] for r in got}
    # A repeated agent row adds nothing.
    again = expand_paths(agents.union(agents), agents.filter("base = 1"), "id", "region")
    assert again.count() == len(chains())


def shuffled_subtrees(df):
    """The plan below each exchange between tasks, as it was run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    lines = plan.toString().split("== Initial Plan ==")[0].split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
            yield "\n".join(lines[at + 1 : end])


def paths_of(spark):
    agents = spark.createDataFrame(AGENTS, "id string, region string, base int")
    return expand_paths(agents, agents.filter("base = 1"), "id", "region", 4)


def test_expand_paths_shuffles_no_chain(spark):
    below = list(shuffled_subtrees(paths_of(spark)))
    assert below and not [x for x in below if "concat(" in x]


def test_expand_paths_shuffles_no_chain_without_broadcast(spark, no_broadcast):
    below = list(shuffled_subtrees(paths_of(spark)))
    assert below and not [x for x in below if "concat(" in x]


def test_expand_paths_without_broadcast(spark, rows, no_broadcast):
    apart = rows(paths_of(spark), "id", "region", "level", "path")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert apart == rows(paths_of(spark), "id", "region", "level", "path") and len(apart) > len(chains())


def test_expand_paths_of_null_and_repeated_keys(spark, rows):
    agents = spark.createDataFrame(
        [(1, "a", "w", 1), (1, "b", "w", 1), (2, "c", "w", 0), (None, "d", "w", 1), (3, "e", None, 1), (3, "f", None, 1)],
        "id int, name string, region string, base int",
    ).drop("base")
    got = expand_paths(agents, agents.filter("name <> 'c'"), "id", "region")
    assert rows(got, "id", "name", "level", "path") == [
        (None, "d", 1, None), (1, "a", 1, "1"), (1, "a", 3, "1 -> 2 -> 1"), (1, "b", 1, "1"), (1, "b", 3, "1 -> 2 -> 1"),
        (2, "c", 2, "1 -> 2"), (3, "e", 1, "3"), (3, "f", 1, "3"),
    ]


def test_count_paths(spark):
    agents = spark.createDataFrame(AGENTS, "id string, region string, base int")
    got = {(r["id"], r["level"]): int(r["paths"]) for r in count_paths(agents, F.col("base") == 1, "id", "region").collect()}
    expected = {}
    for key, level, _ in chains():
        expected[key, level] = expected.get((key, level), 0) + 1
    assert got == expected


def test_closure(spark, rows):
    edges = spark.createDataFrame([("A", "S"), ("S", "M"), ("M", "X"), ("X", "A2"), ("A2", "X")], "c string, p string")
    got = {}
    for holder, held in rows(closure(edges, "c", "p")):
        got.setdefault(holder, set()).add(held)
    assert got["M"] == {"M", "S", "A"}
    assert got["A"] == {"A"}
    assert got["X"] == got["A2"] == {"X", "A2", "M", "S", "A"}
