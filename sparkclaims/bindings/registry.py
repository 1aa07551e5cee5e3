"""Register of the bound queries and of the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.bindings.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: bigint, double, string, boolean."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: comparable(build(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
