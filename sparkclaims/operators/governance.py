"""Column masks, row filters, role inheritance and the data dictionary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.storage import local_table

# Role names, role grants, mask sentinels and dictionary entries.
ANALYST, STEWARD, MANAGER, ADMIN = (
    "ANALYST_ROLE",
    "DATA_STEWARD_ROLE",
    "CLAIMS_MANAGER_ROLE",
    "SYSADMIN",
)
ROLE_GRANTS = [(ANALYST, STEWARD), (STEWARD, MANAGER), (MANAGER, ADMIN)]
DICTIONARY_ENTRIES = [
    ("fact_claims", "fraud_score", "ML model score (0=clean, 1=fraud)", False),
    ("fact_claims", "fraud_flag", "Manual/model fraud label", False),
    ("dim_customers", "annual_income", "Customer declared annual income", True),
    ("dim_customers", "credit_score", "Credit bureau score 300–850", True),
]


@dataclass(frozen=True)
class Mask:
    """Shows a column to ``roles`` only; everybody else sees ``value``."""

    roles: frozenset[str]
    value: object


CUSTOMER_MASKS = {
    "annual_income": Mask(frozenset({MANAGER, ADMIN}), -1),
    "credit_score": Mask(frozenset({STEWARD, ADMIN}), 0),
}


def mask(df: DataFrame, masks: Mapping[str, Mask], role: str) -> DataFrame:
    """``df`` as the current ``role`` sees it; inherited roles do not unmask."""
    hidden = {
        name: F.lit(rule.value).cast(df.schema[name].dataType)
        for name, rule in masks.items()
        if name in df.columns and role not in rule.roles
    }
    return df.withColumns(hidden) if hidden else df


def region_filter(
    df: DataFrame, region: str, role: str, user: str, session_roles: Iterable[str]
) -> DataFrame:
    """Rows the session may see: all for a manager or administrator or with the
    steward role in the session, otherwise those of the region named as the user.

    Claims are restricted by joining them to the filtered agents.
    """
    if role in (ADMIN, MANAGER) or STEWARD in session_roles:
        return df
    return df.filter(F.col(region) == user)


def session_roles(closure_rows: DataFrame, role: str) -> list[str]:
    """The roles a session with ``role`` holds, from a role closure."""
    held = closure_rows.filter(F.col("holder") == role).select("held")
    return [role] + [row[0] for row in held.collect() if row[0] != role]


def data_dictionary(
    tables: Mapping[str, DataFrame], schema_name: str = "dwh", entries=DICTIONARY_ENTRIES
) -> DataFrame:
    """One row per column of ``tables`` with its type and the known annotations."""
    spark = next(iter(tables.values())).sparkSession
    fields = [(table, f) for table, df in tables.items() for f in df.schema.fields]
    columns = local_table(
        spark,
        {
            "table_schema": [schema_name] * len(fields),
            "table_name": [table for table, _ in fields],
            "column_name": [f.name for _, f in fields],
            "data_type": [f.dataType.simpleString() for _, f in fields],
        },
        "table_schema string, table_name string, column_name string, data_type string",
    )
    names = ["table_name", "column_name", "description", "pii_flag"]
    notes = local_table(
        spark,
        {name: [entry[i] for entry in entries] for i, name in enumerate(names)},
        "table_name string, column_name string, description string, pii_flag boolean",
    )
    return columns.join(F.broadcast(notes), ["table_name", "column_name"], "left").na.fill(
        {"pii_flag": False}
    )


def pii_columns(dictionary: DataFrame, table: str) -> list[str]:
    """Names of a table's columns marked as personal."""
    marked = dictionary.filter((F.col("table_name") == table) & F.col("pii_flag"))
    return sorted(row["column_name"] for row in marked.select("column_name").collect())
