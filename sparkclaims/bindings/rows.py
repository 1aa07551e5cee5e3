"""Derived columns, filters and row-level joins."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sparkclaims.bindings.registry import query
from sparkclaims.bindings.tables import Tables
from sparkclaims.functions.bands import experience_band
from sparkclaims.functions.columns import date_key, date_parts, duration_days, full_name, load_stamp, padded_id
from sparkclaims.functions.columns import fill_unknown as fill
from sparkclaims.functions.risk import as_flag
from sparkclaims.functions.risk import payout_ratio as ratio
from sparkclaims.functions.risk import rejected_amount as rejected
from sparkclaims.operators.keys import resolve_key, resolve_key_as_of
from sparkclaims.operators.positions import dense_key, neighbours
from sparkclaims.plans import reports
from sparkclaims.plans.etl import with_normalized_risk, with_policy_risk
from sparkclaims.plans.star import denormalize


@query("band_age", "SELECT customer_id, age, age_band FROM customers")
def band_age(t: Tables):
    return t.customers.select("customer_id", "age", "age_band")


@query(
    "band_income",
    "SELECT customer_id, CAST(annual_income AS DOUBLE) AS annual_income, income_band FROM customers",
)
def band_income(t: Tables):
    return t.customers.select("customer_id", "annual_income", "income_band")


@query("band_credit", "SELECT customer_id, credit_score, credit_band FROM customers")
def band_credit(t: Tables):
    return t.customers.select("customer_id", "credit_score", "credit_band")


@query(
    "band_experience",
    """SELECT agent_id, experience_years,
         CASE WHEN experience_years > 0 AND experience_years <= 4 THEN 'Junior'
           WHEN experience_years > 4 AND experience_years <= 9 THEN 'Mid'
           WHEN experience_years > 9 AND experience_years <= 17 THEN 'Senior'
           WHEN experience_years > 17 THEN 'Expert' END AS experience_band FROM agents""",
)
def band_experience(t: Tables):
    band = experience_band(F.col("experience_years"), [0, 4, 9, 17, None])
    return t.agents.select("agent_id", "experience_years", band.alias("experience_band"))


@query(
    "fill_unknown",
    """SELECT customer_id, coalesce(gender, 'Unknown') AS gender,
         coalesce(marital_status, 'Unknown') AS marital_status FROM raw_customers""",
)
def fill_unknown(t: Tables):
    columns = ["gender", "marital_status"]
    return fill(t.raw_customers, columns).select("customer_id", *columns)


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY annual_income DESC, customer_id) AS customer_key,
         customer_id FROM customers""",
)
def surrogate_key(t: Tables):
    rows = t.customers.select("customer_id", "annual_income")
    order = [F.desc("annual_income"), "customer_id"]
    return dense_key(rows, order, "customer_key").select("customer_key", "customer_id")


@query(
    "payout_ratio",
    """SELECT claim_id, round_even(CASE WHEN claimed_amount > 0
         THEN CAST(approved_amount AS DOUBLE) / CAST(claimed_amount AS DOUBLE) ELSE 0 END, 4)
         AS payout_ratio FROM claims""",
)
def payout_ratio(t: Tables):
    return t.claims.select(
        "claim_id", ratio(F.col("approved_amount"), F.col("claimed_amount")).alias("payout_ratio")
    )


@query(
    "rejected_amount",
    """SELECT claim_id, CAST(round_even(claimed_amount - approved_amount, 2) AS DOUBLE)
         AS rejected_amount FROM claims""",
)
def rejected_amount(t: Tables):
    return t.claims.select(
        "claim_id",
        rejected(F.col("claimed_amount"), F.col("approved_amount")).alias("rejected_amount"),
    )


@query(
    "risk_score_maxnorm",
    """SELECT claim_id, round_even(CAST(fraud_score AS DOUBLE) * 0.5
         + CAST(claimed_amount AS DOUBLE) / (SELECT CAST(max(claimed_amount) AS DOUBLE) FROM claims) * 0.3
         + CAST(processing_days AS DOUBLE) / (SELECT CAST(max(processing_days) AS DOUBLE) FROM claims) * 0.2,
         4) AS risk_score FROM claims""",
)
def risk_score_maxnorm(t: Tables):
    return with_normalized_risk(t.claims).select("claim_id", "risk_score")


@query(
    "date_key",
    """SELECT claim_id, CAST(strftime(claim_date, '%Y%m%d') AS BIGINT) AS date_key,
         year(claim_date) AS year, month(claim_date) AS month, quarter(claim_date) AS quarter,
         fraud = 1 AS fraud_flag FROM claims""",
)
def date_key_of_claims(t: Tables):
    day = F.col("claim_date")
    return t.claims.withColumn("number", F.when(F.col("fraud_flag"), 1).otherwise(0)).select(
        "claim_id",
        date_key(day).alias("date_key"),
        *[part.alias(name) for name, part in date_parts(day).items()],
        as_flag(F.col("number")).alias("fraud_flag"),
    )


@query(
    "policy_duration",
    """SELECT policy_id, CAST(strftime(start_date, '%Y%m%d') AS BIGINT) AS start_date_key,
         CAST(strftime(end_date, '%Y%m%d') AS BIGINT) AS end_date_key,
         CAST(end_date - start_date AS BIGINT) AS policy_duration_days, '2024-06-30' AS load_date
       FROM policies""",
)
def policy_duration(t: Tables):
    start, end = F.col("start_date"), F.col("end_date")
    timed = t.policies.select(
        "policy_id",
        date_key(start).alias("start_date_key"),
        date_key(end).alias("end_date_key"),
        duration_days(start, end).alias("policy_duration_days"),
    )
    return load_stamp(timed, datetime.date(2024, 6, 30))


@query(
    "full_name",
    "SELECT customer_id, first_name || ' ' || last_name AS full_name FROM raw_customers",
)
def full_name_of_customers(t: Tables):
    return t.raw_customers.select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    )


@query(
    "date_dim",
    """SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, year, quarter, month, month_name,
         week, day_of_week, day_name, is_weekend, is_holiday, fiscal_year, fiscal_quarter
       FROM dates""",
)
def date_dim(t: Tables):
    return t.dates


@query(
    "composite_risk",
    """SELECT *, CASE WHEN composite_risk >= 0.7 THEN 'CRITICAL' WHEN composite_risk >= 0.5 THEN 'HIGH'
           WHEN composite_risk >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_label
       FROM (SELECT claim_id, round_even(CAST(fraud_score AS DOUBLE) * 0.5
         + least(CAST(claimed_amount AS DOUBLE) / 500000, 1.0) * 0.3
         + least(CAST(processing_days AS DOUBLE) / 120, 1.0) * 0.2, 4) AS composite_risk FROM claims)""",
)
def composite_risk(t: Tables):
    return reports.scored_claims(t.claims).select("claim_id", "composite_risk", "risk_label")


# Descriptions for the type codes of the test claims; NO has none.
TYPE_TEXTS = {"AF": "Agreed, final", "AO": "Agreed, open", "NF": "New, final", "RF": "Refused, final", "RO": "Refused, open"}


@query(
    "lookup_enrich",
    """SELECT claim_id, claim_type, CASE claim_type WHEN 'AF' THEN 'Agreed, final'
         WHEN 'AO' THEN 'Agreed, open' WHEN 'NF' THEN 'New, final' WHEN 'RF' THEN 'Refused, final'
         WHEN 'RO' THEN 'Refused, open' ELSE 'Unknown' END AS claim_description FROM claims""",
)
def lookup_enrich(t: Tables):
    rows = t.claims.select("claim_id", "claim_type")
    return reports.with_descriptions(rows, "claim_type", TYPE_TEXTS, "claim_description")


@query(
    "high_fraud_filter",
    """SELECT claim_id, CAST(fraud_score AS DOUBLE) AS fraud_score, status FROM claims
       WHERE fraud_flag AND fraud_score > 0.8""",
)
def high_fraud_filter(t: Tables):
    return reports.high_fraud(t.claims)


@query(
    "policy_risk_join",
    """SELECT claim_id, CAST(risk_score AS DOUBLE) AS policy_risk_score
       FROM claims LEFT JOIN policies USING (policy_id)""",
)
def policy_risk_join(t: Tables):
    return with_policy_risk(t.claims, t.policies).select("claim_id", "policy_risk_score")


@query(
    "denormalize_claims",
    """SELECT claim_id, c.policy_id, c.agent_id, p.customer_id, p.policy_type_id, policy_type_name,
         category, region, age_band, income_band, credit_band, gender, city, state
       FROM claims c LEFT JOIN policies p ON c.policy_id = p.policy_id
       LEFT JOIN policy_types y ON p.policy_type_id = y.policy_type_id
       LEFT JOIN agents a ON c.agent_id = a.agent_id
       LEFT JOIN customers u ON p.customer_id = u.customer_id""",
)
def denormalize_claims(t: Tables):
    return denormalize(t.star).select(
        "claim_id", "policy_id", "agent_id", "customer_id", "policy_type_id", "policy_type_name",
        "category", "region", "age_band", "income_band", "credit_band", "gender", "city", "state",
    )


@query(
    "resolve_keys",
    """WITH history AS (
         SELECT customer_id, customer_id * 2 AS customer_key, DATE '1900-01-01' AS f,
           CASE WHEN credit_band = 'Poor' THEN DATE '1998-06-30' ELSE DATE '9999-12-31' END AS u
         FROM customers WHERE annual_income >= 0
         UNION ALL
         SELECT customer_id, customer_id * 2 + 1, DATE '1998-07-01', DATE '9999-12-31'
         FROM customers WHERE credit_band = 'Poor' AND annual_income >= 0)
       SELECT policy_id, p.customer_id, coalesce(customer_key, -1) AS customer_key
       FROM policies p LEFT JOIN history h
         ON p.customer_id = h.customer_id AND start_date BETWEEN f AND u""",
)
def resolve_keys(t: Tables):
    """Customers of poor credit changed on 1998-07-01; those of negative income
    are not loaded."""
    key = F.col("customer_id")
    changed = F.col("credit_band") == "Poor"
    last = F.lit("9999-12-31")
    periods = F.array(
        F.struct(
            (key * 2).alias("customer_key"),
            F.lit("1900-01-01").cast("date").alias("eff_start_date"),
            F.when(changed, F.lit("1998-06-30")).otherwise(last).cast("date").alias("eff_end_date"),
        ),
        F.when(
            changed,
            F.struct(
                (key * 2 + 1).alias("customer_key"),
                F.lit("1998-07-01").cast("date").alias("eff_start_date"),
                last.cast("date").alias("eff_end_date"),
            ),
        ),
    )
    history = t.customers.filter("annual_income >= 0").select(
        "customer_id", F.inline(F.array_compact(periods))
    )
    rows = t.policies.select("policy_id", "customer_id", "start_date")
    return resolve_key(rows, history, "customer_id", "customer_key", "start_date").drop("start_date")


_ORDER_DAYS = """days AS (SELECT customer_id, start_date AS f, min(policy_id) AS customer_key,
           lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) - 1 AS u FROM policies GROUP BY 1, 2)"""


@query(
    "resolve_keys_as_of",
    f"""WITH {_ORDER_DAYS}
       SELECT policy_id, p.customer_id, coalesce(customer_key, -1) AS customer_key FROM policies p
       LEFT JOIN days h ON p.customer_id = h.customer_id AND p.start_date - 30 BETWEEN f AND coalesce(u, f + 400)""",
)
def resolve_keys_as_of(t: Tables):
    """Customers have a version from each day on which they took a policy, the
    last for 400 days; policies take the one of 30 days before."""
    days = t.policies.groupBy("customer_id", F.col("start_date").alias("eff_start_date")).agg(
        F.min("policy_id").alias("customer_key")
    )
    ends = neighbours(days, ["customer_id"], ["eff_start_date"], after={"_next": F.col("eff_start_date")})
    until = F.coalesce(F.date_sub("_next", 1), F.date_add("eff_start_date", 400))
    facts = t.policies.select("policy_id", "customer_id", F.date_sub("start_date", 30).alias("day"))
    versions = ends.withColumn("eff_end_date", until).drop("_next")
    return resolve_key_as_of(facts, versions, "customer_id", "customer_key", "day").drop("day")


@query(
    "padded_ids",
    """SELECT customer_id, 'CUST' || CASE WHEN customer_id < 1000000 THEN lpad(CAST(customer_id AS VARCHAR), 6, '0')
         ELSE CAST(customer_id AS VARCHAR) END AS customer_code FROM raw_customers""",
)
def padded_ids(t: Tables):
    return t.raw_customers.select("customer_id", padded_id("CUST", F.col("customer_id"), 6).alias("customer_code"))
