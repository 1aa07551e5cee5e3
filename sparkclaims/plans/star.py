"""The star that the reports read, and its joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.functions.risk import flag_count
from sparkclaims.operators.joins import Dimension, sized, skew_join, star_aggregate, unique_by


@dataclass(frozen=True)
class ClaimStar:
    """Claims and the tables around them, on natural keys.

    ``claims`` names its policy and day (``date_key``); ``policies`` leads to
    the customer and policy type, and to the agent unless claims name one.
    """

    claims: DataFrame
    policies: DataFrame
    customers: DataFrame
    policy_types: DataFrame
    agents: DataFrame
    dates: DataFrame

    def current_customers(self) -> DataFrame:
        """One row per customer; the current one of a history."""
        if "is_current" in self.customers.columns:
            return self.customers.filter(F.col("is_current"))
        return self.customers


# Which table leads to a key that claims do not carry.
_ON_POLICY = ["customer_id", "policy_type_id", "agent_id"]


def dimensions(star: ClaimStar, attributes: Sequence[str], how: str = "inner") -> list[Dimension]:
    """The joins that bring ``attributes`` to the claims, smallest tables first."""
    wanted = set(attributes) - set(star.claims.columns)
    tables = {
        "date_key": star.dates,
        "policy_type_id": star.policy_types,
        "agent_id": star.agents,
        "customer_id": star.current_customers(),
    }
    chosen = {}
    for key, table in tables.items():
        found = [a for a in attributes if a in wanted and a in table.columns and a != key]
        if found:
            chosen[key] = Dimension(table, key, found, how)
            wanted -= set(found)
    through_policy = [
        key
        for key in _ON_POLICY
        if (key in chosen or key in wanted) and key not in star.claims.columns
    ]
    direct = [d for key, d in chosen.items() if key not in through_policy]
    indirect = [d for key, d in chosen.items() if key in through_policy]
    policy = [Dimension(star.policies, "policy_id", through_policy, how)] if through_policy else []
    missing = wanted - set(through_policy)
    if missing:
        raise ValueError(f"no table of the star has {sorted(missing)}")
    return [*direct, *policy, *indirect]


def aggregate(
    star: ClaimStar, by: Sequence[str], sums: Mapping[str, Column], how: str = "inner"
) -> DataFrame:
    """Additive measures of the claims, grouped by attributes of the star."""
    return star_aggregate(star.claims, dimensions(star, by, how), by, sums)


def count_claims() -> Column:
    return F.lit(1).cast("long")


def score_sums() -> dict[str, Column]:
    """Sum and number of known scores, for an average."""
    return {
        "score_sum": F.col("fraud_score"),
        "score_rows": F.col("fraud_score").isNotNull().cast("long"),
    }


def fraud_claims() -> Column:
    return flag_count(F.col("fraud_flag"))


def denormalize(star: ClaimStar) -> DataFrame:
    """Claims with policy, policy type, agent and customer attributes; claims
    without a match keep nulls. A repeated key of a joined table raises.

    What hangs on the policy is joined to the policies first, so the claims
    themselves meet one large table.
    """
    claims = star.claims
    on_policy = [key for key in _ON_POLICY if key not in claims.columns]
    tables = [
        (star.policy_types, "policy_type_id", ["policy_type_name", "category"]),
        (star.agents, "agent_id", ["region"]),
        (
            star.current_customers(),
            "customer_id",
            ["age_band", "income_band", "credit_band", "gender", "city", "state"],
        ),
    ]

    def rows(table: DataFrame, key: str, *attributes: str) -> DataFrame:
        return sized(unique_by(table.select(key, *attributes), [key]))

    def frequencies(table: DataFrame, key: str) -> DataFrame:
        return table.groupBy(key).agg(F.count("*").alias("_rows"))

    policies = unique_by(star.policies.select("policy_id", *on_policy), ["policy_id"])
    joined = claims
    for table, key, attributes in tables:
        named = rows(table, key, *attributes)
        if key in on_policy:
            policies = skew_join(policies, named, [key], frequencies=lambda key=key: frequencies(star.policies, key))
        else:
            joined = skew_join(joined, named, [key], frequencies=lambda key=key: frequencies(claims, key))
    joined = skew_join(joined, policies, ["policy_id"], frequencies=lambda: frequencies(claims, "policy_id"))
    return joined.select(*claims.columns, *on_policy, *[name for _, _, attributes in tables for name in attributes])
