"""Claim streams: sources, alerts, running totals, windows and ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sparkclaims.functions.columns import rounded_avg
from sparkclaims.functions.risk import alert_level, flag_count
from sparkclaims.schemas import CLAIM_STREAM
from sparkclaims.storage import delete_folder

WATERMARK = "10 minutes"


def csv_stream(
    spark: SparkSession, folder: str, schema: T.StructType = CLAIM_STREAM, files_per_batch: int = 1000
) -> DataFrame:
    """New CSV files of a folder; ``files_per_batch`` bounds a micro-batch."""
    return (
        spark.readStream.schema(schema)
        .options(header=True, maxFilesPerTrigger=files_per_batch)
        .csv(folder)
    )


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .options(pathGlobFilter=pattern, maxFilesPerTrigger=files_per_batch)
        .parquet(folder)
    )


def event_time(df: DataFrame, column: str = "claim_date") -> DataFrame:
    """The column as a timestamp, which a watermark needs; bad text is null."""
    return df.withColumn(column, F.col(column).try_cast("timestamp"))


def alerts(claims: DataFrame) -> DataFrame:
    """Fraud claims with an alert level. Stateless, so no watermark."""
    return claims.filter(F.col("fraud_flag").cast("boolean")).select(
        "claim_id",
        "claim_type",
        "claimed_amount",
        "fraud_score",
        alert_level(F.col("fraud_score")).alias("alert_level"),
        "status",
    )


def _totals() -> list[Column]:
    return [
        F.count("*").alias("claim_count"),
        F.sum(flag_count(F.col("fraud_flag"))).alias("fraud_count"),
        rounded_avg(F.col("fraud_score"), 4).alias("avg_fraud_score"),
    ]


def type_totals(claims: DataFrame) -> DataFrame:
    """Totals by claim type; the state holds one row per type."""
    return claims.groupBy("claim_type").agg(*_totals())


def tumbling_totals(
    claims: DataFrame, time: str = "claim_date", length: str = "1 day", delay: str = WATERMARK
) -> DataFrame:
    """Totals by claim type and window; a window is final, and its state
    dropped, once the watermark passes its end."""
    return (
        claims.withWatermark(time, delay)
        .groupBy(F.window(time, length), "claim_type")
        .agg(*_totals())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "claim_type",
            "claim_count",
            "fraud_count",
            "avg_fraud_score",
        )
    )


def _available(writer: DataStreamWriter, checkpoint: str) -> DataStreamWriter:
    """Process what is there and stop."""
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)


def append_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Files and checkpoint make every row come exactly once."""
    return _available(df.writeStream.outputMode("append").format("parquet"), checkpoint).start(path)


def each_batch(df: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """``save(rows, batch id)`` for each micro-batch; it may run twice for one id."""
    return _available(df.writeStream.foreachBatch(save), checkpoint).start()


def complete_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the whole result of each micro-batch to ``path/batch=<n>``.

    The result before it stays for those who read it; older ones are deleted.
    """

    def save(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        delete_folder(result.sparkSession, f"{path}/batch={batch - 2}")

    return _available(df.writeStream.outputMode("complete").foreachBatch(save), checkpoint).start()


def latest_complete(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last complete result in ``path``."""
    every = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    return every.filter(F.col("batch") == every.agg(F.max("batch")).scalar()).drop("batch")


def show_batches(df: DataFrame, mode: str, checkpoint: str) -> StreamingQuery:
    """Print the result of each micro-batch, for a look at a small stream."""
    return _available(df.writeStream.outputMode(mode).format("console").option("truncate", False), checkpoint).start()


def ingest_csv(
    spark: SparkSession, folder: str, schema: T.StructType, staging: str, checkpoint: str
) -> StreamingQuery:
    """Load the files of ``folder`` that no earlier run has loaded."""
    return append_to_files(csv_stream(spark, folder, schema), staging, checkpoint)


def ingest_status(query: StreamingQuery) -> dict:
    """What an ingest is doing, and the rows of its last micro-batch with data."""
    loaded = [p for p in query.recentProgress if p["numInputRows"]]
    return {
        "active": query.isActive,
        "message": query.status["message"],
        "rows_in_last_batch": loaded[-1]["numInputRows"] if loaded else 0,
        "rows_in_all": sum(p["numInputRows"] for p in loaded),
    }
