"""Tumbling windows that keep the rows which come too late.

Spark's own watermark drops a row whose window is closed, and what is dropped
depends on how the files fall into micro-batches. Here each micro-batch is
split by the watermark of those before it: rows in time go into the sums of
their window, late ones, and those without a time, to a side table by batch
id. A window is final once the watermark passes its end, as usual; windows and
side table together hold every row once, however the batches are cut.

Everything a batch writes follows from the rows of the batch and from what
earlier ids have written, and replaces what an earlier run of the same id has
written. So a batch that runs twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.functions.columns import rounded_ratio
from sparkclaims.functions.risk import flag_count
from sparkclaims.operators.summary import merge_summaries
from sparkclaims.storage import delete_folder, materialize, scratch, written_versions
from sparkclaims.streaming.claims import WATERMARK

SUMS = ["claim_count", "fraud_count", "fraud_score_sum", "fraud_score_rows"]


@dataclass(frozen=True)
class LateWindows:
    """Windows of claims in the folder ``base``.

    ``state/version=<batch>`` has the sums of the windows that the batch closed
    (``closed=1``) and of those still open; ``late/batch=<batch>`` its late
    rows; ``marks/version=<batch>`` the latest time seen so far. The state
    holds one row per open window and type.
    """

    base: str
    time: str = "claim_date"
    length: str = "1 day"
    delay: str = WATERMARK
    by: str = "claim_type"

    @property
    def keys(self) -> list[str]:
        return ["window_start", "window_end", self.by]

    def sums(self, rows: DataFrame) -> DataFrame:
        """Sums by window; a row without a time has no window."""
        score = F.col("fraud_score").cast("decimal(20,9)")
        start, end = F.col("_window.start"), F.col("_window.end")
        return (
            rows.withColumn("_window", F.window(self.time, self.length))
            .groupBy(start.alias("window_start"), end.alias("window_end"), self.by)
            .agg(
                F.count("*").alias("claim_count"),
                F.sum(flag_count(F.col("fraud_flag"))).alias("fraud_count"),
                F.sum(score).cast("decimal(38,9)").alias("fraud_score_sum"),
                F.count(score).alias("fraud_score_rows"),
            )
        )

    def _marks(self, spark: SparkSession, before: int | None) -> DataFrame:
        """``seen`` after the last batch below ``before`` (of all: None); no row without any."""
        done = [v for v in written_versions(spark, f"{self.base}/marks") if before is None or v < before]
        if not done:
            return spark.createDataFrame([], "seen timestamp")
        return spark.read.schema("seen timestamp").parquet(f"{self.base}/marks/version={done[-1]}")

    def watermark(self, spark: SparkSession, before: int | None = None) -> Column:
        """The latest time of the batches below ``before`` less the delay; null without any."""
        return self._marks(spark, before).select(F.max("seen") - F.expr(f"INTERVAL {self.delay}")).scalar()

    def split(self, rows: DataFrame, watermark: Column) -> tuple[DataFrame, DataFrame]:
        """``(rows in time, other rows)``: the others' window is closed, or they have no time."""
        timed = rows.filter(F.col(self.time).isNotNull()).withColumn("_window", F.window(self.time, self.length))
        late = F.coalesce(F.col("_window.end") <= watermark, F.lit(False))
        untimed = rows.filter(F.col(self.time).isNull())
        return timed.filter(~late).drop("_window"), timed.filter(late).drop("_window").unionByName(untimed)

    def save(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""

        def apply(rows: DataFrame, batch: int) -> None:
            spark = rows.sparkSession
            with scratch(spark):
                # The batch is read once; the writes below see the same rows.
                self._apply(spark, materialize(rows, "late-batch"), batch)

        return apply

    def _apply(self, spark: SparkSession, rows: DataFrame, batch: int) -> None:
        before = self.watermark(spark, batch)
        in_time, late = self.split(rows, before)
        late.withColumn("watermark", before).write.mode("overwrite").parquet(f"{self.base}/late/batch={batch}")
        times = rows.select(F.col(self.time).cast("timestamp").alias("seen")).unionByName(self._marks(spark, batch))
        times.agg(F.max("seen").alias("seen")).write.mode("overwrite").parquet(f"{self.base}/marks/version={batch}")
        merged = self._merged(spark, batch, self.sums(in_time))
        closed = F.coalesce(F.col("window_end") <= self.watermark(spark, batch + 1), F.lit(False))
        merged.withColumn("closed", closed.cast("int")).write.mode("overwrite").partitionBy("closed").parquet(
            f"{self.base}/state/version={batch}"
        )
        # The state that was merged stays for those who read it.
        for version in self._below(spark, batch)[-4:-1]:
            delete_folder(spark, f"{self.base}/state/version={version}/closed=0")

    def _below(self, spark: SparkSession, batch: int) -> list[int]:
        return [v for v in written_versions(spark, f"{self.base}/state") if v < batch]

    def _merged(self, spark: SparkSession, batch: int, delta: DataFrame) -> DataFrame:
        below = self._below(spark, batch)
        if not below:
            return delta
        still_open = self._state(spark, delta.schema).filter((F.col("version") == below[-1]) & (F.col("closed") == 0))
        return merge_summaries(still_open.select(*delta.columns), delta, self.keys, SUMS)

    def _state(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Every version; partition filters decide what is read."""
        whole = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField("closed", T.IntegerType())])
        return spark.read.schema(whole).parquet(f"{self.base}/state")

    def windows(self, spark: SparkSession, schema: T.StructType, closed: bool = True) -> DataFrame:
        """The sums of the windows that are final, or of those still open. A batch
        ends before the next begins, so all versions up to the last are whole."""
        last = written_versions(spark, f"{self.base}/state")[-1]
        kept = F.col("version") <= last if closed else F.col("version") == last
        state = self._state(spark, self.sums(spark.createDataFrame([], schema)).schema)
        return state.filter(kept & (F.col("closed") == int(closed))).drop("version", "closed")

    def late_rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The rows of the side table, with the batch that brought them and the watermark they met."""
        whole = T.StructType([*schema.fields, T.StructField("watermark", T.TimestampType()), T.StructField("batch", T.LongType())])
        last = written_versions(spark, f"{self.base}/state")[-1]
        return spark.read.schema(whole).parquet(f"{self.base}/late").filter(F.col("batch") <= last)

    def corrected(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The sums of all windows with their late rows: the same for any batches."""
        late = self.late_rows(spark, schema).filter(F.col(self.time).isNotNull())
        both = self.windows(spark, schema).unionByName(self.windows(spark, schema, closed=False))
        return merge_summaries(both, self.sums(late), self.keys, SUMS)


def totals(sums: DataFrame) -> DataFrame:
    """The windows as they are read, from their sums."""
    average = rounded_ratio(F.col("fraud_score_sum"), F.col("fraud_score_rows"), 4).alias("avg_fraud_score")
    return sums.select(*[c for c in sums.columns if not c.startswith("fraud_score_")], average)
