"""The test tables seen as claims, policies, customers and agents.

The same views are stated twice: as DataFrames and as SQL for the check.
All are projections of their tables, built anew for each query, so a query
always sees the tables as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.functions.columns import date_key, fill_unknown, full_name
from sparkclaims.functions.dates import date_dimension
from sparkclaims.plans.etl import with_bands
from sparkclaims.plans.star import ClaimStar

# Columns that together identify a claim.
TIE = ["policy_id", "line_no", "part_id", "agent_id", "claimed_amount", "claim_date"]
TIE_SQL = ", ".join(TIE)

class Tables:
    """The views over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def claims(self) -> DataFrame:
        claimed = F.col("l_extendedprice").cast("decimal(15,2)")
        day = F.col("l_shipdate").cast("date")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("agent_id"),
            day.alias("claim_date"),
            date_key(day).alias("date_key"),
            F.concat("l_returnflag", "l_linestatus").alias("claim_type"),
            claimed.alias("claimed_amount"),
            (claimed * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("approved_amount"),
            claim_status(F.round(F.col("l_tax") * 100).cast("int") % 5).alias("status"),
            (F.col("l_returnflag") == "R").alias("fraud_flag"),
            (F.col("l_discount") * 10).cast("decimal(6,4)").alias("fraud_score"),
            F.col("l_quantity").cast("int").alias("processing_days"),
        ).withColumn("claim_id", claim_id())

    @property
    def policies(self) -> DataFrame:
        start = F.col("o_orderdate").cast("date")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("policy_type_id"),
            start.alias("start_date"),
            F.date_add(start, 365).alias("end_date"),
            F.col("o_totalprice").cast("decimal(15,2)").alias("premium_amount"),
            (F.col("o_totalprice").cast("decimal(15,2)") * 10).cast("decimal(15,2)").alias("coverage_amount"),
            F.col("o_orderstatus").alias("status"),
            ((F.col("o_orderkey") % 900 + 100) / 100).cast("decimal(5,2)").alias("risk_score"),
        )

    @property
    def raw_customers(self) -> DataFrame:
        """Customers before the load: some genders and last names are null."""
        key = F.col("c_custkey")
        nations = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state")
        )
        return self.raw("customer").join(nations, "c_nationkey").select(
            key.alias("customer_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.when(key % 11 != 0, F.substring_index("c_name", "#", -1)).alias("last_name"),
            (key % 57 + 18).cast("int").alias("age"),
            F.when(key % 13 != 0, F.col("c_mktsegment")).alias("gender"),
            F.when(key % 7 != 0, F.lit("Married")).alias("marital_status"),
            (F.col("c_acctbal").cast("decimal(15,2)") * 20).cast("decimal(15,2)").alias("annual_income"),
            (key * 37 % 551 + 300).cast("int").alias("credit_score"),
            F.concat("state", F.lit("/"), (key % 4).cast("string")).alias("city"),
            "state",
        )

    @property
    def customers(self) -> DataFrame:
        filled = fill_unknown(with_bands(self.raw_customers), ["gender", "marital_status"])
        return filled.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))

    @property
    def agents(self) -> DataFrame:
        key = F.col("s_suppkey")
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name")
        return self.raw("supplier").join(places, "s_nationkey").select(
            key.alias("agent_id"),
            F.col("s_name").alias("agent_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            (key % 19 + 1).cast("int").alias("experience_years"),
        )

    @property
    def policy_types(self) -> DataFrame:
        kind = F.col("policy_type_id")
        return self.policies.select(kind).distinct().select(
            kind,
            F.substring(kind, 3, 20).alias("policy_type_name"),
            F.when(F.substring(kind, 1, 1).isin("1", "2"), "Fast")
            .when(F.substring(kind, 1, 1) == "3", "Normal")
            .otherwise("Slow")
            .alias("category"),
        )

    @property
    def dates(self) -> DataFrame:
        span = self.claims.agg(F.min("claim_date").alias("d0"), F.max("claim_date").alias("d1"))
        return date_dimension(span, "d0", "d1", fiscal_start_month=4)

    @property
    def star(self) -> ClaimStar:
        return ClaimStar(
            self.claims, self.policies, self.customers, self.policy_types, self.agents, self.dates
        )

    @property
    def event_schema(self) -> T.StructType:
        return self.raw("events").schema

    def stream_claims(self, events: DataFrame) -> DataFrame:
        """Events, batch or stream, in the shape of the claim stream."""
        return events.select(
            F.col("event_id").alias("claim_id"),
            F.col("user_id").alias("policy_id"),
            F.col("ts").cast("timestamp").alias("claim_date"),
            F.col("event_type").alias("claim_type"),
            F.col("value").alias("claimed_amount"),
            (F.col("event_id") % 101 / 100).cast("decimal(6,4)").alias("fraud_score"),
            (F.col("event_id") % 8 == 0).alias("fraud_flag"),
            F.col("event_type").alias("status"),
        )


def claim_id() -> Column:
    """The identity of a claim as text, from the columns of ``TIE``."""
    return F.concat_ws("-", *[F.col(name).cast("string") for name in TIE])


def claim_status(number: Column) -> Column:
    return (
        F.when(number == 0, "Approved")
        .when(number == 1, "Pending")
        .when(number == 2, "Rejected")
        .when(number == 3, "Under Investigation")
        .otherwise("Settled")
    )


VIEWS = {
    "claims": """SELECT *, approved_amount_x AS approved_amount,
        CAST(year(claim_date) * 10000 + month(claim_date) * 100 + day(claim_date) AS BIGINT) AS date_key
      FROM (SELECT *, claimed_amount * (1 - disc) AS approved_amount_x,
        concat_ws('-', policy_id, line_no, part_id, agent_id,
                  CAST(claimed_amount AS VARCHAR), CAST(claim_date AS VARCHAR)) AS claim_id
      FROM (SELECT l_orderkey AS policy_id, l_linenumber AS line_no, l_partkey AS part_id,
        l_suppkey AS agent_id, CAST(l_shipdate AS DATE) AS claim_date,
        l_returnflag || l_linestatus AS claim_type,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS claimed_amount,
        CAST(l_discount AS DECIMAL(4,2)) AS disc,
        CASE CAST(round(l_tax * 100) AS INTEGER) % 5 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Pending'
          WHEN 2 THEN 'Rejected' WHEN 3 THEN 'Under Investigation' ELSE 'Settled' END AS status,
        l_returnflag = 'R' AS fraud_flag,
        CAST(l_returnflag = 'R' AS BIGINT) AS fraud,
        CAST(l_discount * 10 AS DECIMAL(6,4)) AS fraud_score,
        CAST(l_quantity AS BIGINT) AS processing_days FROM lineitem))""",
    "policies": """SELECT o_orderkey AS policy_id, o_custkey AS customer_id,
        o_orderpriority AS policy_type_id, CAST(o_orderdate AS DATE) AS start_date,
        CAST(o_orderdate AS DATE) + 365 AS end_date,
        CAST(o_totalprice AS DECIMAL(15,2)) AS premium_amount,
        CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 10 AS DECIMAL(15,2)) AS coverage_amount,
        o_orderstatus AS status,
        CAST((o_orderkey % 900 + 100) / 100.0 AS DECIMAL(5,2)) AS risk_score FROM orders""",
    "raw_customers": """SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
        CASE WHEN c_custkey % 11 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
        c_custkey % 57 + 18 AS age,
        CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS gender,
        CASE WHEN c_custkey % 7 <> 0 THEN 'Married' END AS marital_status,
        CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 20 AS DECIMAL(15,2)) AS annual_income,
        c_custkey * 37 % 551 + 300 AS credit_score,
        n_name || '/' || CAST(c_custkey % 4 AS VARCHAR) AS city, n_name AS state
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "customers": """SELECT customer_id, first_name, last_name, age,
        coalesce(gender, 'Unknown') AS gender, coalesce(marital_status, 'Unknown') AS marital_status,
        annual_income, credit_score, city, state, first_name || ' ' || last_name AS full_name,
        CASE WHEN age > 0 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35'
          WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 55 THEN '46-55'
          WHEN age > 55 AND age <= 65 THEN '56-65' WHEN age > 65 AND age <= 120 THEN '65+' END AS age_band,
        CASE WHEN annual_income > 0 AND annual_income <= 40000 THEN 'Low'
          WHEN annual_income > 40000 AND annual_income <= 80000 THEN 'Medium'
          WHEN annual_income > 80000 AND annual_income <= 150000 THEN 'High'
          WHEN annual_income > 150000 THEN 'Very High' END AS income_band,
        CASE WHEN credit_score > 0 AND credit_score <= 579 THEN 'Poor'
          WHEN credit_score > 579 AND credit_score <= 669 THEN 'Fair'
          WHEN credit_score > 669 AND credit_score <= 739 THEN 'Good'
          WHEN credit_score > 739 AND credit_score <= 799 THEN 'Very Good'
          WHEN credit_score > 799 AND credit_score <= 850 THEN 'Excellent' END AS credit_band
      FROM raw_customers""",
    "agents": """SELECT s_suppkey AS agent_id, s_name AS agent_name, r_name AS region,
        n_name AS nation,
        s_suppkey % 19 + 1 AS experience_years
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
    "policy_types": """SELECT DISTINCT o_orderpriority AS policy_type_id,
        substr(o_orderpriority, 3) AS policy_type_name,
        CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Fast'
          WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Normal' ELSE 'Slow' END AS category
      FROM orders""",
    "dates": """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date,
        year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
        week(d) AS week, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name,
        isodow(d) >= 6 AS is_weekend, false AS is_holiday,
        year(d + INTERVAL 9 MONTH) AS fiscal_year, quarter(d + INTERVAL 9 MONTH) AS fiscal_quarter
      FROM (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d
            FROM lineitem)""",
    "stream_claims": """SELECT event_id AS claim_id, user_id AS policy_id, ts AS claim_date,
        event_type AS claim_type, value AS claimed_amount,
        CAST((event_id % 101) / 100.0 AS DECIMAL(6,4)) AS fraud_score,
        event_id % 8 = 0 AS fraud_flag, CAST(event_id % 8 = 0 AS BIGINT) AS fraud,
        event_type AS status FROM events""",
}
_NEEDS = {"customers": ["raw_customers"]}


def with_views(body: str) -> str:
    """``body`` with definitions for the views it mentions."""
    used = [name for name in VIEWS if f" {name}" in body]
    for name, more in _NEEDS.items():
        if name in used:
            used += [m for m in more if m not in used]
    ordered = sorted(used, key=list(VIEWS).index)
    if not ordered:
        return body
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    rest = body.lstrip()
    if rest.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {rest[len('WITH RECURSIVE '):]}"
    if rest.startswith("WITH "):
        return f"WITH {views}, {rest[len('WITH '):]}"
    return f"WITH {views} {rest}"
