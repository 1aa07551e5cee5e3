"""Schemas of the claim tables, declared so that no read infers types."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

STRING, INT, SHORT, DATE = StringType(), IntegerType(), ShortType(), DateType()
DOUBLE, BOOLEAN, MONEY = DoubleType(), BooleanType(), DecimalType(15, 2)


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


CUSTOMERS = table(
    customer_id=STRING,
    first_name=STRING,
    last_name=STRING,
    age=INT,
    gender=STRING,
    marital_status=STRING,
    occupation=STRING,
    annual_income=MONEY,
    credit_score=INT,
    city=STRING,
    state=STRING,
    created_date=DATE,
)
POLICY_TYPES = table(
    policy_type_id=STRING,
    policy_type_name=STRING,
    category=STRING,
    base_premium_rate=DecimalType(6, 4),
    max_coverage_amount=MONEY,
)
AGENTS = table(
    agent_id=STRING,
    agent_name=STRING,
    region=STRING,
    experience_years=INT,
    performance_rating=DecimalType(3, 1),
)
# The date file carries date_id; the warehouse publishes it as date_key.
DATES = table(
    date_id=INT,
    full_date=DATE,
    year=SHORT,
    quarter=SHORT,
    month=SHORT,
    month_name=STRING,
    week=SHORT,
    day_of_week=SHORT,
    day_name=STRING,
    is_weekend=SHORT,
    is_holiday=SHORT,
)
POLICIES = table(
    policy_id=STRING,
    customer_id=STRING,
    policy_type_id=STRING,
    agent_id=STRING,
    start_date=DATE,
    end_date=DATE,
    premium_amount=MONEY,
    coverage_amount=MONEY,
    deductible_amount=MONEY,
    status=STRING,
    risk_score=DecimalType(5, 2),
)
CLAIMS = table(
    claim_id=STRING,
    policy_id=STRING,
    claim_date=DATE,
    claim_type=STRING,
    claimed_amount=MONEY,
    approved_amount=MONEY,
    status=STRING,
    fraud_flag=SHORT,
    fraud_score=DecimalType(6, 4),
    processing_days=INT,
    adjuster_notes=STRING,
    date_id=INT,
)
CLAIM_DOCUMENT = table(
    claim_id=STRING,
    metadata=table(
        claim_type=STRING,
        status=STRING,
        fraud_indicators=table(
            is_fraud=BOOLEAN, fraud_score=DOUBLE, flags=ArrayType(STRING)
        ),
    ),
    financial=table(claimed_amount=DOUBLE, approved_amount=DOUBLE, processing_days=INT),
)
# claim_date arrives as text and is parsed to a timestamp before any watermark.
CLAIM_STREAM = table(
    claim_id=STRING,
    policy_id=STRING,
    claim_date=STRING,
    claim_type=STRING,
    claimed_amount=DOUBLE,
    fraud_score=DOUBLE,
    fraud_flag=BOOLEAN,
    status=STRING,
)

SOURCE_TABLES = {
    "dim_customers": CUSTOMERS,
    "fact_policies": POLICIES,
    "fact_claims": CLAIMS,
    "dim_agents": AGENTS,
    "dim_policy_types": POLICY_TYPES,
    "dim_date": DATES,
}
