"""Physical plans of the bound queries."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as bound
from sparkclaims.bindings.tables import Tables
from sparkclaims.plans import reports
from sparkclaims.storage import materialize

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in bound.queries() if not n.startswith("stream")))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(bound.queries()[name](spark, FOLDER))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def single_partition_inputs(text):
    """What feeds each exchange to one partition."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "SinglePartition" in line]


@pytest.mark.parametrize("name", sorted(n for n in bound.queries() if not n.startswith("stream")))
def test_one_partition_only_for_partial_results(spark, many_blocks, name):
    """Only partial aggregates and per-block tables meet in one task."""
    for line in single_partition_inputs(plan(bound.queries()[name](spark, FOLDER))):
        assert re.search(r"partial_|HashAggregate\(keys=\[_block", line), line


@pytest.fixture(scope="module")
def stored(spark):
    return materialize(Tables(spark, FOLDER).claims, "claims")


def scanned(text):
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    return {re.sub(r"#.*", "", c) for c in columns.split(",")}


def test_filter_reaches_the_scan(stored):
    text = plan(reports.high_fraud(stored))
    assert "GreaterThan(fraud_score" in text.split("PushedFilters")[1]
    assert scanned(text) == {"claim_id", "fraud_flag", "fraud_score", "status"}


def test_columns_are_pruned(spark):
    text = plan(bound.queries()["claims_by_type"](spark, FOLDER))
    assert scanned(text) == {
        "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_quantity",
    }


def test_rank_filter_limits_early(spark):
    assert "WindowGroupLimit" in plan(bound.queries()["monthly_fraud_top3"](spark, FOLDER))


def test_top_k_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan(bound.queries()["top_cities"](spark, FOLDER))


@pytest.mark.parametrize("name", ["claims_rollup", "fraud_cube"])
def test_subtotals_expand_aggregated_rows(spark, name):
    text = plan(bound.queries()[name](spark, FOLDER))
    assert "HashAggregate" in text[text.index("Expand"):]


def test_maxima_are_found_in_one_pass(spark):
    text = plan(bound.queries()["risk_score_maxnorm"](spark, FOLDER))
    assert "mergedValue" in text
