"""Claims as JSON documents: build, parse, extract and flatten."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Paths and types of the claim document.
CLAIM_PATHS = {
    "claim_id_json": ("$.claim_id", "string"),
    "claim_type": ("$.metadata.claim_type", "string"),
    "status": ("$.metadata.status", "string"),
    "is_fraud": ("$.metadata.fraud_indicators.is_fraud", "boolean"),
    "fraud_score": ("$.metadata.fraud_indicators.fraud_score", "double"),
    "claimed_amount": ("$.financial.claimed_amount", "double"),
    "approved_amount": ("$.financial.approved_amount", "double"),
}
FLAGS_PATH = "$.metadata.fraud_indicators.flags"


def build_document(
    claim_id: Column,
    claim_type: Column,
    status: Column,
    is_fraud: Column,
    fraud_score: Column,
    flags: Column,
    claimed_amount: Column,
    approved_amount: Column,
    processing_days: Column,
) -> Column:
    """The nested claim document as JSON text."""
    indicators = F.struct(
        is_fraud.alias("is_fraud"), fraud_score.alias("fraud_score"), flags.alias("flags")
    )
    return F.to_json(
        F.struct(
            claim_id.alias("claim_id"),
            F.struct(
                claim_type.alias("claim_type"),
                status.alias("status"),
                indicators.alias("fraud_indicators"),
            ).alias("metadata"),
            F.struct(
                claimed_amount.alias("claimed_amount"),
                approved_amount.alias("approved_amount"),
                processing_days.alias("processing_days"),
            ).alias("financial"),
        )
    )


def parse_variant(df: DataFrame, text: str, name: str = "raw_json") -> DataFrame:
    """Adds the document as a variant; malformed text becomes null."""
    return df.withColumn(name, F.try_parse_json(text))


def extract_paths(
    df: DataFrame, variant: str, paths: Mapping[str, tuple[str, str]], keep: list[str]
) -> DataFrame:
    """Typed columns from variant paths; a missing path or a bad value is null."""
    return df.select(
        *keep,
        *[F.try_variant_get(variant, path, kind).alias(name) for name, (path, kind) in paths.items()],
    )


def flatten_flags(df: DataFrame, variant: str, keep: list[str], name: str) -> DataFrame:
    """One row per element of the flags; documents without any are dropped."""
    flags = F.try_variant_get(variant, FLAGS_PATH, "array<string>")
    return df.select(*keep, F.explode(flags).alias(name))
