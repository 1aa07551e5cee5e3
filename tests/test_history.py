"""Histories from changes in any order, keys as of a day, and the ordered helpers under them."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import history
from sparkclaims.operators.keys import resolve_key, resolve_key_as_of
from sparkclaims.operators.positions import carry_last, neighbours

DAY = datetime.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


EVENTS = "k string, day date, no long, v string, gone boolean"


def changes(spark, *rows):
    """Rows of key, day number, change number, value and whether it deletes."""
    return spark.createDataFrame([(k, day(d), no, v, gone) for k, d, no, v, gone in rows], EVENTS)


def expected(rows):
    """key, first and last day (None: open) and value of each period."""
    out = []
    for key in {r[0] for r in rows}:
        line = {}
        for _, d, no, v, gone in sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: (r[2], r[3] or "")):
            line[d] = (v, bool(gone))
        kept, old = [], None
        for d in sorted(line):
            if line[d] != old:
                kept.append((d, *line[d]))
            old = line[d]
        for at, (d, v, gone) in enumerate(kept):
            if not gone:
                out.append((key, d, kept[at + 1][0] - 1 if at + 1 < len(kept) else None, v))
    return sorted(out, key=repr)


def drawn(df):
    found = df.select("k", "eff_start_date", "eff_end_date", "is_current", "v").collect()
    number = lambda d: (d - DAY).days
    assert all(r["is_current"] == (r["eff_end_date"].year == 9999) for r in found)
    return sorted(
        ((r["k"], number(r["eff_start_date"]), None if r["is_current"] else number(r["eff_end_date"]), r["v"]) for r in found), key=repr
    )


def random_rows(seed, count=60):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.randrange(40), no, rng.choice(["x", "y", None]), rng.random() < 0.2) for no in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_same_history(spark, seed):
    rows = random_rows(seed)
    for shuffle in (0, 1):
        random.Random(shuffle).shuffle(rows)
        events = changes(spark).limit(0)
        past = history.periods(events, ["k"], "day", ["v"], F.col("gone"))
        for part in (rows[:25], rows[25:30], rows[30:], rows[:3]):
            events, past = history.apply_changes(events, past, changes(spark, *part), ["k"], "day", ["no"], ["v"], F.col("gone"))
        assert drawn(past) == expected(rows)


def test_a_late_change_splits_a_period_that_looked_unchanged(spark):
    """x, then x again: one period, until a y between them arrives."""
    first = changes(spark, ("a", 0, 1, "x", False), ("a", 10, 2, "x", False))
    assert drawn(history.periods(first, ["k"], "day", ["v"])) == [("a", 0, None, "x")]
    events = history.add_changes(first, changes(spark, ("a", 5, 3, "y", False)), ["k"], "day", ["no"])
    assert drawn(history.periods(events, ["k"], "day", ["v"])) == [("a", 0, 4, "x"), ("a", 10, None, "x"), ("a", 5, 9, "y")]


def test_periods_over_many_blocks(spark, many_blocks):
    rows = {(k, d): v for k, d, _, v, _ in random_rows(3, 400)}
    rows = [(k, d, 1, v, d % 7 == 0) for (k, d), v in rows.items()]
    got = history.periods(changes(spark, *rows), ["k"], "day", ["v"], F.col("gone"), block_rows=3)
    assert drawn(got) == expected(rows)


def test_events_without_a_day_or_with_repeats(spark):
    rows = [("a", None, 1, "x", False), ("a", 3, 2, "x", None), ("a", 3, 2, "x", None), ("a", 3, 1, "old", False)]
    events = history.add_changes(changes(spark).limit(0), changes(spark, *rows), ["k"], "day", ["no"])
    assert events.count() == 2
    assert drawn(history.periods(events, ["k"], "day", ["v"], F.col("gone"))) == [("a", 3, None, "x")]


def test_keys_that_a_load_does_not_name_are_taken_over(spark):
    rows = [("a", 0, 1, "x", False), ("b", 0, 1, "x", False)]
    events = changes(spark, *rows)
    past = history.periods(events, ["k"], "day", ["v"]).withColumn("eff_end_date", F.when(F.col("k") == "b", F.lit(day(99))).otherwise(F.col("eff_end_date")))
    _, after = history.apply_changes(events, past, changes(spark, ("a", 1, 2, "y", False)), ["k"], "day", ["no"], ["v"])
    assert {(r["k"], r["eff_start_date"], r["eff_end_date"]) for r in after.collect()} == {
        ("a", day(0), day(0)), ("a", day(1), datetime.date(9999, 12, 31)), ("b", day(0), day(99)),
    }


def test_neighbours_and_carried_values_over_blocks(spark, many_blocks):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), n, rng.choice([None, None, n])) for n in range(200)]
    df = spark.createDataFrame(rows, "g string, n int, v int")
    near = neighbours(df, ["g"], ["n"], {"old": F.col("v"), "at": F.col("n")}, {"next": F.col("n")}, block_rows=4)
    carried = carry_last(df, ["g"], ["n"], F.col("v"), "last", block_rows=4)
    want_near, want_last = set(), set()
    for g in ("a", "b", None):
        own = [r for r in rows if r[0] == g]
        last = None
        for at, (_, n, v) in enumerate(own):
            last = v if v is not None else last
            old = own[at - 1] if at else (None, None, None)
            want_near.add((g, n, old[2], old[1], own[at + 1][1] if at + 1 < len(own) else None))
            want_last.add((g, n, last))
    assert {(r["g"], r["n"], r["old"], r["at"], r["next"]) for r in near.collect()} == want_near
    assert {(r["g"], r["n"], r["last"]) for r in carried.collect()} == want_last


@pytest.fixture
def versions(spark):
    rows = [("a", 10, day(0), day(4)), ("a", 11, day(5), day(6)), ("a", 12, day(9), day(300)), ("b", 20, day(3), None), (None, 30, day(0), day(300)), ("c", 40, None, day(300))]
    return spark.createDataFrame(rows, "id string, key long, eff_start_date date, eff_end_date date")


def test_keys_as_of_a_day(spark, versions, rows):
    facts = [(i, k, day(d)) for i, (k, d) in enumerate([(k, d) for k in ("a", "b", "c", None, "z") for d in (-1, 0, 4, 5, 6, 7, 9, 300, 301, None)])]
    df = spark.createDataFrame(facts, "n int, id string, day date")
    want = rows(resolve_key(df, versions, "id", "key", "day"), "n", "key")
    for block_rows in (None, 3):
        got = resolve_key_as_of(df, versions, "id", "key", "day", block_rows)
        assert got.columns == ["n", "id", "day", "key"] and rows(got, "n", "key") == want
    assert {k for _, k in want} == {-1, 10, 11, 12}


def test_keys_as_of_a_day_make_no_pairs(spark, versions):
    """A hot key of many versions: no join of facts and versions is in the plan."""
    facts = spark.range(500).selectExpr("id AS n", "'a' AS id", "date_add(DATE '2024-01-01', CAST(id % 400 AS INT)) AS day")
    many = spark.range(300).selectExpr(
        "'a' AS id", "id AS key", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS eff_start_date", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS eff_end_date"
    )
    got = resolve_key_as_of(facts, many, "id", "key", "day", 50)
    assert {(r["day"] - DAY).days if r["key"] >= 0 else -1 for r in got.collect()} == {*range(300), -1}
    assert all(r["key"] in (-1, (r["day"] - DAY).days) for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "eff_start_date" not in plan


def test_two_periods_of_one_day_raise(spark, versions):
    facts = spark.createDataFrame([(1, "a", day(0))], "n int, id string, day date")
    with pytest.raises(Exception, match="duplicate key"):
        resolve_key_as_of(facts, versions.unionAll(versions), "id", "key", "day").collect()


def test_facts_or_versions_of_nothing(spark, versions, rows):
    facts = spark.createDataFrame([(1, "a", day(0))], "n int, id string, day date")
    assert rows(resolve_key_as_of(facts, versions.limit(0), "id", "key", "day"), "n", "key") == [(1, -1)]
    assert resolve_key_as_of(facts.limit(0), versions, "id", "key", "day").count() == 0
