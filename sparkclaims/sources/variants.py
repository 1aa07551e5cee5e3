"""Documents stored as shredded variants.

Fields that most documents have, with one type, become Parquet columns of
their own; what does not fit stays in the variant's value. Spark chooses the
fields from the rows it writes. A read of some paths then scans their columns
and no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings that a shredded write and a pruned read need; they are Spark's defaults.
WRITE_SETTINGS = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")
READ_SETTINGS = ("spark.sql.variant.allowReadingShredded", "spark.sql.variant.pushVariantIntoScan")


def _need(spark: SparkSession, settings: tuple[str, ...]) -> None:
    off = [name for name in settings if spark.conf.get(name) != "true"]
    if off:
        raise ValueError(f"shredded variants need {', '.join(off)}")


def write_documents(df: DataFrame, path: str) -> None:
    """Write a table with variant columns; each is shredded by the fields its documents share."""
    _need(df.sparkSession, WRITE_SETTINGS)
    df.write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The table; paths that are taken from a variant right away are read by themselves."""
    _need(spark, READ_SETTINGS)
    return spark.read.parquet(path)
