"""The batch load: read, transform, check, write, record the run."""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.functions.bands import age_band, credit_band, income_band
from sparkclaims.functions.columns import (
    date_key,
    duration_days,
    fill_unknown,
    full_name,
    load_stamp,
)
from sparkclaims.functions.risk import as_flag, max_normalized_risk, payout_ratio, rejected_amount
from sparkclaims.operators.joins import skew_join, unique_by
from sparkclaims.operators.merge import initial_history
from sparkclaims.operators.positions import dense_key
from sparkclaims.operators.quality import quality_report, require_quality
from sparkclaims.sources.readers import read_source_tables
from sparkclaims.sources.writers import write_run_stats, write_tables
from sparkclaims.storage import delete_folder, materialize, publish, scratch


def with_bands(customers: DataFrame, missing: str | None = None) -> DataFrame:
    return customers.withColumns(
        {
            "age_band": age_band(F.col("age"), missing),
            "income_band": income_band(F.col("annual_income"), missing),
            "credit_band": credit_band(F.col("credit_score"), missing),
        }
    )


def transform_customers(customers: DataFrame, as_of: datetime.date) -> DataFrame:
    """Banded customers with a surrogate key, as the first load of a history."""
    filled = fill_unknown(with_bands(customers), ["gender", "marital_status"])
    named = filled.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))
    return initial_history(dense_key(named, ["customer_id"], "customer_key"), as_of)


def transform_policies(policies: DataFrame, as_of: datetime.date) -> DataFrame:
    """Policies with duration, date keys and the load date."""
    return load_stamp(
        policies.withColumns(
            {
                "policy_duration_days": duration_days(F.col("start_date"), F.col("end_date")),
                "start_date_key": date_key(F.col("start_date")),
                "end_date_key": date_key(F.col("end_date")),
            }
        ),
        as_of,
    )


def with_normalized_risk(
    claims: DataFrame, name: str = "risk_score", largest_of: DataFrame | None = None
) -> DataFrame:
    """Adds the score against the table's largest amount and duration, which one
    aggregation finds. ``largest_of`` has the same rows where ``claims`` is costly to run."""
    largest = (claims if largest_of is None else largest_of).agg(
        F.max("claimed_amount").alias("claimed"), F.max("processing_days").alias("days")
    )
    return claims.withColumn(
        name,
        max_normalized_risk(
            F.col("fraud_score"),
            F.col("claimed_amount"),
            F.col("processing_days"),
            largest.select("claimed").scalar(),
            largest.select("days").scalar(),
        ),
    )


def with_policy_risk(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Adds the risk score of the claim's policy; a repeated policy raises."""
    scores = policies.select("policy_id", F.col("risk_score").alias("policy_risk_score"))
    return skew_join(claims, unique_by(scores, ["policy_id"]), ["policy_id"])


def with_ratios(claims: DataFrame) -> DataFrame:
    """Adds what follows from the claim's own amounts."""
    claimed, approved = F.col("claimed_amount"), F.col("approved_amount")
    return claims.withColumns(
        {
            "payout_ratio": payout_ratio(approved, claimed),
            "rejected_amount": rejected_amount(claimed, approved),
        }
    )


def transform_claims(claims: DataFrame, policies: DataFrame, as_of: datetime.date) -> DataFrame:
    """Claims with ratios, scores, date key and the load date."""
    # The columns that follow from others are made after the join, which deals out the claims.
    added = ["payout_ratio", "rejected_amount", "risk_score", "policy_risk_score"]
    scored = with_normalized_risk(with_ratios(with_policy_risk(claims, policies)), largest_of=claims)
    given = [c for c in claims.columns if c not in added]
    return load_stamp(
        scored.select(*given, *added).withColumns(
            {
                "date_id": date_key(F.col("claim_date")),
                "fraud_flag": as_flag(F.col("fraud_flag")),
            }
        ),
        as_of,
    )


def checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Quality reports on the tables to load.

    The transformations keep rows, keys and scores, and their joins refuse
    repeated keys. So the figures come from the source rows, without the joins.
    """
    ratios = with_ratios(tables["fact_claims"]).select("claim_id", "fraud_score", "payout_ratio")
    return [
        quality_report(tables["dim_customers"].select("customer_id"), "dim_customers", ["customer_id"]),
        quality_report(tables["fact_policies"].select("policy_id"), "fact_policies", ["policy_id"]),
        quality_report(ratios, "fact_claims", ["claim_id"]),
    ]


def transform(tables: Mapping[str, DataFrame], as_of: datetime.date) -> dict[str, DataFrame]:
    """The warehouse tables from the source tables."""
    policies = transform_policies(tables["fact_policies"], as_of)
    return {
        "dwh_dim_customers": transform_customers(tables["dim_customers"], as_of),
        "dwh_fact_policies": policies,
        "dwh_fact_claims": transform_claims(tables["fact_claims"], policies, as_of),
        "dwh_dim_agents": tables["dim_agents"],
        "dwh_dim_policy_type": tables["dim_policy_types"],
        "dwh_dim_date": tables["dim_date"].withColumnRenamed("date_id", "date_key"),
    }


def run(
    spark: SparkSession,
    source: str,
    target: str,
    as_of: datetime.date | None = None,
    kind: str = "parquet",
) -> dict[str, int]:
    """Load the source files into ``target`` and return the rows per table.

    The source files are parsed once, into typed tables of the shared scratch
    folder. All tables are written beside the old ones and put in their place
    at the end, so nothing changes when a check or a write fails. The run
    record in ``target/run_log`` is written whatever happens.
    """
    started, clock = datetime.datetime.now(), time.monotonic()
    rows: dict[str, int] = {}
    error = None
    try:
        with scratch(spark):
            sources = read_source_tables(spark, source)
            tables = {name: materialize(table, f"staged-{name}", compression="zstd") for name, table in sources.items()}
            for report in checks(tables):
                require_quality(report)
            loading = f"{target}/_loading-{uuid.uuid4().hex}"
            try:
                written = write_tables(transform(tables, as_of or started.date()), loading, kind)
                for name in written:
                    file = f"{name}.csv" if kind == "csv" else name
                    publish(spark, f"{loading}/{file}", f"{target}/{file}")
            finally:
                delete_folder(spark, loading)
        rows = written
        return rows
    except Exception as problem:
        error = str(problem)
        raise
    finally:
        write_run_stats(
            spark,
            f"{target}/run_log",
            "SUCCESS" if error is None else "FAILED",
            started,
            time.monotonic() - clock,
            rows,
            error,
        )
