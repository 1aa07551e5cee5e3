"""Every bound query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as bound
import check

from sparkclaims.bindings.registry import ORACLES, QUERIES

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return check.duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(bound.queries())


def test_entry(spark):
    assert bound.entry(spark).count() == 6


# The smallest tables hold no row for these.
SPARSE = {"agent_paths", "agent_path_counts", "agent_path_listing", "mv_fraud_query"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SPARSE))
def test_query(spark, connection, name):
    assert check.difference(spark, connection, FOLDER, name) == ""


@pytest.mark.parametrize("name", sorted(SPARSE))
def test_query_on_more_rows(spark, name):
    assert check.difference(spark, check.duck(LARGER), LARGER, name) == ""


SORTED = {
    # The columns by which each report is stated to be sorted. '-' is descending; nulls
    # come first, or last with '?'.
    "claims_by_type": ["-fraud_pct?", "claim_type"],
    "fraud_by_category": ["-fraud_rate_pct?", "category"],
    "risk_label_counts": ["-claim_count", "risk_label"],
    "customer_risk": ["-avg_fraud_score", "-total_claims", "customer_id"],
    "monthly_trend_window": ["policy_type_name", "year", "month"],
    "claims_rollup": ["region", "policy_type", "year", "grouping_id"],
    "fraud_cube": ["-fraud_rate_pct?", "age_band", "gender", "policy_category"],
    "mv_fraud_query": ["-avg_fraud_score", "quarter", "policy_type_name", "region"],
    "monthly_fraud_top3": ["year", "month", "fraud_rank", "claim_type"],
    "type_rates": ["total", "claim_type"],
    "category_rate_band": ["-fraud_rate", "category"],
    "region_perf": ["-fraud_rate", "region"],
    "top_cities": ["-fraud_count", "city"],
    "json_flatten": ["-fraud_score", "claim_id", "fraud_indicator_flag"],
}


def in_order(first, second, columns):
    """Whether two rows may follow each other."""
    for column in columns:
        name, down, nulls_last = column.strip("-?"), column[0] == "-", column[-1] == "?"
        a, b = first[name], second[name]
        if a == b:
            continue
        if a is None or b is None:
            return (b is None) == nulls_last
        return (a > b) == down
    return True


@pytest.mark.parametrize("name", sorted(SORTED))
def test_order(spark, name):
    found = bound.queries()[name](spark, LARGER if name in SPARSE else FOLDER).collect()
    assert len(found) > 1
    assert all(in_order(a, b, SORTED[name]) for a, b in zip(found, found[1:], strict=False))


def test_queries_see_a_changed_table(spark, tmp_path):
    """Nothing of an earlier query is kept, and released scratch is not read again."""
    from sparkclaims import storage

    folder = tmp_path / "tables"
    folder.mkdir()
    for name in ("customer", "nation"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    with storage.scratch(spark):
        few = QUERIES["band_age"](spark, str(folder)).count()
    spark.read.parquet(f"{LARGER}/customer.parquet").write.mode("overwrite").parquet(f"{folder}/customer.parquet")
    assert QUERIES["band_age"](spark, str(folder)).count() > few > 0


def test_scratch_is_deleted(spark):
    import os

    from sparkclaims import storage

    with storage.scratch(spark) as folder:
        table = storage.materialize(spark.range(3), "x")
        assert table.count() == 3 and os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


LARGE = [
    "fraud_by_category", "customer_risk", "monthly_trend_window", "fraud_percentile", "claims_rollup",
    "fraud_cube", "age_band_rates", "region_perf", "top_cities", "denormalize_claims", "policy_risk_join",
    "resolve_keys", "role_closure",
]


@pytest.mark.parametrize("name", LARGE)
def test_query_without_broadcast(spark, connection, no_broadcast, monkeypatch, name):
    """The plans for large dimensions, with keys salted from few rows on."""
    from sparkclaims.operators import joins

    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    assert check.difference(spark, connection, FOLDER, name) == ""
