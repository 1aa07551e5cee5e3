from __future__ import annotations

import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sparkclaims.functions import bands, columns, risk
from sparkclaims.functions.dates import date_dimension
from sparkclaims.plans.etl import with_normalized_risk
from sparkclaims.plans.reports import with_descriptions

DAY = datetime.date


def values(spark, expression, items, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_age_bands(spark):
    ages = [0, 18, 25, 26, 65, 66, 120, 121, None]
    expected = [None, "18-25", "18-25", "26-35", "56-65", "65+", "65+", None, None]
    assert values(spark, bands.age_band, ages, "int") == expected
    filled = values(spark, lambda c: bands.age_band(c, missing="nan"), ages, "int")
    assert filled == [e or "nan" for e in expected]


def test_income_bands(spark):
    incomes = [D(0), D(40000), D(40001), D(80000), D(150000), D(150001), None]
    expected = [None, "Low", "Medium", "Medium", "High", "Very High", None]
    assert values(spark, bands.income_band, incomes, "decimal(15,2)") == expected


def test_credit_bands(spark):
    scores = [0, 579, 580, 669, 739, 799, 850, 851]
    expected = [None, "Poor", "Fair", "Fair", "Good", "Very Good", "Excellent", None]
    assert values(spark, bands.credit_band, scores, "int") == expected


def test_caller_thresholds(spark):
    assert values(spark, lambda c: bands.experience_band(c, [0, 2, 5, 10, None]), [1, 2, 3, 10, 11], "int") == [
        "Junior", "Junior", "Mid", "Senior", "Expert",
    ]
    assert values(spark, lambda c: bands.performance_band(c, [0, 3, 4, 5]), [2.5, 3.5, 4.5, 5.5], "double") == [
        "Low", "Average", "High", None,
    ]
    assert values(spark, lambda c: bands.risk_band(c, [0, 1, 2, 3]), [1, 2, 3], "int") == ["Low", "Medium", "High"]
    with pytest.raises(ValueError):
        bands.bin_column(F.lit(1), [0, 1], ["a", "b"])


def test_payout_and_rejected(spark):
    df = spark.createDataFrame(
        [
            (1, D("0"), D("5")),
            (2, None, D("5")),
            (3, D("10"), D("15")),
            (4, D("20000"), D("1")),
            (5, D("3"), D("1")),
        ],
        "i int, claimed decimal(15,2), approved decimal(15,2)",
    )
    got = df.orderBy("i").select(
        risk.payout_ratio(F.col("approved"), F.col("claimed")),
        risk.rejected_amount(F.col("claimed"), F.col("approved")),
    ).collect()
    # 0.00005 lies on a tie and goes to the even neighbour.
    assert [r[0] for r in got] == [0.0, 0.0, 1.5, 0.0, 0.3333]
    assert [r[1] for r in got] == [D("-5"), None, D("-5"), D("19999"), D("2")]


def test_flags(spark):
    assert values(spark, risk.as_flag, [0, 1, None], "smallint") == [False, True, None]
    assert values(spark, risk.flag_count, [0, 1, None], "smallint") == [0, 1, 0]


def test_composite_risk(spark):
    df = spark.createDataFrame(
        [
            (1, None, None, None),
            (2, 1.0, 500000.0, 120),
            (3, 1.0, 900000.0, 400),
            (4, 0.6, None, None),
            (5, 1.0, None, None),
            (6, 1.0, None, 120),
            (7, 0.59, None, None),
        ],
        "i int, s double, c double, d int",
    )
    score = risk.composite_risk(F.col("s"), F.col("c"), F.col("d"))
    got = df.orderBy("i").select(score, risk.composite_label(score)).collect()
    assert [tuple(r) for r in got] == [
        (0.0, "LOW"), (1.0, "CRITICAL"), (1.0, "CRITICAL"), (0.3, "MEDIUM"), (0.5, "HIGH"),
        (0.7, "CRITICAL"), (0.295, "LOW"),
    ]


def test_normalized_risk(spark):
    schema = "fraud_score double, claimed_amount double, processing_days int"
    df = spark.createDataFrame([(1.0, 100.0, 10), (0.0, 50.0, 5), (None, 50.0, 5)], schema)
    got = [r["risk_score"] for r in with_normalized_risk(df).orderBy(F.desc_nulls_last("fraud_score")).collect()]
    assert got == [1.0, 0.25, None]
    zero = spark.createDataFrame([(1.0, 0.0, 0)], schema)
    assert with_normalized_risk(zero).first()["risk_score"] is None


def test_levels(spark):
    alerts = values(spark, risk.alert_level, [0.8, 0.79, 0.5, 0.49, None], "double")
    assert [a.split()[1] for a in alerts] == ["CRITICAL", "HIGH", "HIGH", "NORMAL", "NORMAL"]
    assert values(spark, risk.rate_level, [13.1, 13.0, 11.0, 10.0], "double") == [
        "danger", "warning", "success", "success",
    ]


def test_customer_levels(spark):
    df = spark.createDataFrame(
        [
            (1, 0.7, 0, 1), (2, 0.0, 3, 3), (3, 0.4, 0, 1), (4, 0.1, 0, 5), (5, 0.2, 0, 1), (6, 0.1, 0, 3),
            (7, 0.1, 2, 2), (8, None, 3, 3), (9, None, 0, 1),
        ],
        "i int, a double, f int, n int",
    )
    level = risk.customer_risk_level(F.col("a"), F.col("f"), F.col("n"))
    assert [r[0] for r in df.orderBy("i").select(level).collect()] == [
        "CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "CRITICAL", "LOW",
    ]


def test_names_keys_and_durations(spark):
    df = spark.createDataFrame(
        [("A", "B", None, DAY(2024, 2, 28), DAY(2025, 2, 27)), ("A", None, "x", DAY(2021, 1, 1), DAY(2020, 12, 31))],
        "f string, l string, g string, s date, e date",
    )
    got = (
        columns.load_stamp(columns.fill_unknown(df, ["g"]), DAY(2024, 6, 30))
        .select(
            columns.full_name(F.col("f"), F.col("l")), "g", columns.date_key(F.col("s")),
            columns.duration_days(F.col("s"), F.col("e")), "load_date",
            columns.padded_id("CLM", F.lit(42), 7),
        )
        .collect()
    )
    assert [tuple(r) for r in got] == [
        ("A B", "Unknown", 20240228, 365, DAY(2024, 6, 30), "CLM0000042"),
        (None, "x", 20210101, -1, DAY(2024, 6, 30), "CLM0000042"),
    ]


def test_rounding_is_exact_on_ties(spark):
    df = spark.createDataFrame([(D("38.9"), 80), (D("-38.9"), 80), (D("1"), 0)], "t decimal(16,4), n bigint")
    got = [r[0] for r in df.select(columns.rounded_ratio(F.col("t"), F.col("n"), 4)).collect()]
    assert got == [D("0.4863"), D("-0.4863"), None]


def test_date_dimension(spark):
    bounds = spark.createDataFrame([(DAY(2020, 2, 28), DAY(2021, 1, 4))], "a date, b date")
    holidays = spark.createDataFrame([(DAY(2020, 12, 25),), (DAY(2020, 12, 25),)], "full_date date")
    dim = date_dimension(bounds, "a", "b", holidays, fiscal_start_month=4)
    got = {r["full_date"]: r for r in dim.collect()}
    assert len(got) == 312
    leap, new_year = got[DAY(2020, 2, 29)], got[DAY(2021, 1, 1)]
    assert (leap["date_key"], leap["day_name"], leap["day_of_week"], leap["is_weekend"]) == (20200229, "Saturday", 5, True)
    assert (leap["fiscal_year"], leap["fiscal_quarter"]) == (2020, 4)
    assert (new_year["week"], new_year["month_name"], new_year["day_of_week"]) == (53, "January", 4)
    assert got[DAY(2021, 1, 4)]["week"] == 1
    assert (got[DAY(2020, 4, 1)]["fiscal_year"], got[DAY(2020, 4, 1)]["fiscal_quarter"]) == (2021, 1)
    assert [d for d, r in got.items() if r["is_holiday"]] == [DAY(2020, 12, 25)]


def test_lookup_default(spark, rows):
    df = spark.createDataFrame([("Fire",), ("Other",), (None,)], "claim_type string")
    got = with_descriptions(df, "claim_type", {"Fire": "Fire damage"}, "text")
    assert rows(got, "claim_type", "text") == [(None, "Unknown"), ("Fire", "Fire damage"), ("Other", "Unknown")]
