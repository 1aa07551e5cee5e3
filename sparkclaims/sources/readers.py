"""CSV, JSON and Parquet readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.schemas import CLAIM_DOCUMENT, SOURCE_TABLES

# Spellings of null in bulk-load files.
NULL_SPELLINGS = ["NULL", "null", ""]
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A CSV table with a header; a missing path is an error."""
    return spark.read.schema(schema).options(header=True, enforceSchema=False, **options).csv(path)


def read_source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every source table found under its own name in ``folder``."""
    return {
        name: read_csv(spark, f"{folder}/{name}.csv", schema)
        for name, schema in SOURCE_TABLES.items()
    }


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType = CLAIM_DOCUMENT
) -> DataFrame:
    """Files that each hold one JSON array. A file is read by one task, so a
    large load comes as many files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_variant_array(spark: SparkSession, path: str, name: str = "raw_json") -> DataFrame:
    """Files that each hold one JSON array, as one variant per element."""
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "_all").json(path)
    return spark.sql(f"SELECT value AS {name} FROM {{whole}}, LATERAL variant_explode(_all)", whole=whole)


def read_variant_lines(spark: SparkSession, path: str, name: str = "raw_json") -> DataFrame:
    """One JSON document per line as a variant; malformed lines become null."""
    return spark.read.text(path).select(F.try_parse_json("value").alias(name))


def read_parquet_field(spark: SparkSession, path: str, *fields: str) -> DataFrame:
    """Some columns of Parquet files; the scan reads no other."""
    return spark.read.parquet(path).select(*fields)


def _nulls(name: str) -> Column:
    return F.when(F.col(name).isin(NULL_SPELLINGS), None).otherwise(F.col(name)).alias(name)


def copy_into(
    spark: SparkSession, path: str | list[str], schema: T.StructType, file_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bulk load: ``(good, rejected)`` rows of CSV files with a header, optional
    double quotes and three spellings of null.

    A row with too many or too few fields, or a field that is no value of its
    type, is rejected as a whole and reported as text with the columns at fault.
    ``file_column`` names a column that holds the file of each row.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(texts.add(CORRUPT, T.StringType()))
        .options(
            header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
        )
        .csv(path)
    )
    names = [f.name for f in schema.fields]
    origin = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
    source = [] if file_column is None else [file_column]
    cleaned = raw.select(*[_nulls(name) for name in names], CORRUPT, *origin)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    wrong = F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name))
                for name, value in typed.items()
            ]
        )
    )
    checked = cleaned.withColumn("bad_columns", wrong)
    is_good = F.col(CORRUPT).isNull() & (F.size("bad_columns") == 0)
    good = checked.filter(is_good).select(*[value.alias(name) for name, value in typed.items()], *source)
    rejected = checked.filter(~is_good).select(*names, F.col(CORRUPT).alias("line"), "bad_columns", *source)
    return good, rejected
