from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import governance, quality
from sparkclaims.operators import semistructured as docs


def report(df, keys=("k",)):
    return quality.quality_report(df, "t", list(keys)).first()


def test_null_tolerance(spark):
    at_limit = spark.createDataFrame([(None if i == 0 else i,) for i in range(20)], "k int")
    r = report(at_limit)
    assert r["passed"] and r["null_pct_k"] == 0.05
    above = spark.createDataFrame([(None if i == 0 else i,) for i in range(19)], "k int")
    r = report(above)
    assert not r["passed"]
    assert r["issues"] == ["k: 5.3% of the values are missing, 5% may be"]


def test_duplicates_count_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,)] + [(i,) for i in range(2, 60)], "k int")
    r = report(df)
    assert r["duplicates"] == 3 and r["issues"] == ["3 rows repeat a key of k"]
    assert quality.duplicate_count(df, ["k"]).first()["duplicates"] == 3


def test_ranges(spark):
    df = spark.createDataFrame([(1, -0.1, 1.0), (2, 1.1, -0.5), (3, None, None), (4, 0.5, 2.0)], "k int, fraud_score double, payout_ratio double")
    r = report(df)
    assert r["issues"] == ["2 fraud scores outside 0 to 1", "1 payout ratios under 0"]
    assert "fraud_score_out_of_range" not in report(df.select("k")).asDict()


def test_empty_table_passes(spark):
    r = report(spark.createDataFrame([], "k int, fraud_score double"))
    assert r["passed"] and r["total_rows"] == 0 and r["null_pct_k"] is None


def test_gate(spark):
    good = quality.quality_report(spark.range(3), "ids", ["id"])
    assert quality.require_quality(good) == 3
    bad = quality.quality_report(spark.range(3).union(spark.range(3)), "ids", ["id"])
    with pytest.raises(quality.QualityError, match="ids"):
        quality.require_quality(good.unionByName(bad))


def test_one_read_per_report(spark):
    path_plan = quality.quality_report(spark.range(10), "t", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert path_plan.count("Range") == 1


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(quality.null_profile(df, "t")) == [("t", 2, "a", 1), ("t", 2, "b", 2)]


ROLES = [governance.ANALYST, governance.STEWARD, governance.MANAGER, governance.ADMIN, "OTHER"]


def test_masks_follow_the_current_role(spark):
    df = spark.createDataFrame([(50000, 700)], "annual_income int, credit_score int")
    seen = {role: tuple(governance.mask(df, governance.CUSTOMER_MASKS, role).first()) for role in ROLES}
    assert seen == {
        governance.ANALYST: (-1, 0),
        governance.STEWARD: (-1, 700),
        governance.MANAGER: (50000, 0),
        governance.ADMIN: (50000, 700),
        "OTHER": (-1, 0),
    }
    assert governance.mask(df, governance.CUSTOMER_MASKS, "OTHER").dtypes == df.dtypes


def test_region_filter(spark, rows):
    grants = spark.createDataFrame(governance.ROLE_GRANTS, "role string, granted_to string")
    from sparkclaims.operators.paths import closure

    held = closure(grants, "role", "granted_to")
    agents = spark.createDataFrame([("a", "North"), ("b", "South"), ("c", None)], "id string, region string")

    def seen(role, user):
        roles = governance.session_roles(held, role)
        return [r[0] for r in rows(governance.region_filter(agents, "region", role, user, roles), "id")]

    assert seen(governance.ANALYST, "North") == ["a"]
    assert seen(governance.ANALYST, "Nobody") == []
    assert seen("OTHER", "South") == ["b"]
    for role in (governance.STEWARD, governance.MANAGER, governance.ADMIN):
        assert seen(role, "Nobody") == ["a", "b", "c"]


def test_dictionary(spark):
    tables = {
        "dim_customers": spark.createDataFrame([], "customer_id string, annual_income decimal(15,2), credit_score int"),
        "fact_claims": spark.createDataFrame([], "fraud_flag boolean"),
    }
    dictionary = governance.data_dictionary(tables)
    assert dictionary.count() == 4
    assert governance.pii_columns(dictionary, "dim_customers") == ["annual_income", "credit_score"]
    assert governance.pii_columns(dictionary, "fact_claims") == []


DOCUMENT = """{"claim_id":"C1","metadata":{"claim_type":"Fire","status":"Pending","fraud_indicators":
{"is_fraud":true,"fraud_score":0.9,"flags":["late_filing","x"]}},
"financial":{"claimed_amount":10.5,"approved_amount":1.0,"processing_days":3}}"""


@pytest.fixture
def documents(spark):
    texts = [
        (1, DOCUMENT),
        (2, DOCUMENT.replace('["late_filing","x"]', "[]")),
        (3, DOCUMENT.replace(',"flags":["late_filing","x"]', "")),
        (4, DOCUMENT[:40]),
        (5, DOCUMENT.replace("0.9", '"high"')),
    ]
    return docs.parse_variant(spark.createDataFrame(texts, "i int, t string"), F.col("t"))


def test_extract(documents):
    got = {r["i"]: r for r in docs.extract_paths(documents, "raw_json", docs.CLAIM_PATHS, ["i"]).collect()}
    assert got[1].asDict() == {
        "i": 1, "claim_id_json": "C1", "claim_type": "Fire", "status": "Pending", "is_fraud": True,
        "fraud_score": 0.9, "claimed_amount": 10.5, "approved_amount": 1.0,
    }
    assert got[4]["claim_type"] is None
    assert got[5]["fraud_score"] is None and got[5]["claim_type"] == "Fire"


def test_flatten(documents, rows):
    assert rows(docs.flatten_flags(documents, "raw_json", ["i"], "f")) == [
        (1, "late_filing"), (1, "x"), (5, "late_filing"), (5, "x"),
    ]


def test_build_and_parse_again(spark):
    built = spark.range(1).select(
        docs.build_document(
            F.lit("C1"), F.lit("Fire"), F.lit("Pending"), F.lit(True), F.lit(0.9),
            F.array(F.lit("late_filing"), F.lit("x")), F.lit(10.5), F.lit(1.0), F.lit(3),
        ).alias("t")
    )
    assert built.first()["t"] == DOCUMENT.replace("\n", "")
