"""Precomputed summaries: full build, incremental refresh and reading."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.operators import sketches
from sparkclaims.operators.joins import unique_by
from sparkclaims.storage import delete_folder, written_versions

KEYS = ["year", "quarter", "policy_type_name", "region"]
SUMS = ["claim_count", "total_claimed", "total_approved", "fraud_score_sum", "fraud_score_rows", "fraud_count"]


def merge_summaries(
    old: DataFrame, new: DataFrame, keys: Sequence[str], sums: Sequence[str], sketched: Sequence[str] = ()
) -> DataFrame:
    """Sums, and quantile sketches, of two summaries of disjoint facts; averages are never merged."""
    return old.unionByName(new).groupBy(*keys).agg(
        *[F.sum(name).cast(old.schema[name].dataType).alias(name) for name in sums],
        *[sketches.merged(name).alias(name) for name in sketched],
    )


def write_summary(summary: DataFrame, base: str, version: int, keys: Sequence[str] = KEYS) -> str:
    """Write a version of the summary; a repeated key stops the write."""
    path = f"{base}/version={version}"
    unique_by(summary, keys).write.mode("errorifexists").parquet(path)
    return path


def refresh_incremental(
    spark: SparkSession, base: str, version: int, delta: DataFrame, keys=KEYS, sums=SUMS
) -> DataFrame:
    """Write ``version`` from the one before it and the summary of new facts."""
    old = spark.read.parquet(f"{base}/version={version - 1}")
    path = write_summary(merge_summaries(old, delta, keys, sums), base, version, keys)
    return spark.read.parquet(path)


def refresh_batch(
    spark: SparkSession, base: str, batch: int, delta: DataFrame, keys: Sequence[str] = KEYS,
    sums: Sequence[str] = SUMS, sketched: Sequence[str] = (),
) -> str:
    """Merge the summary of one batch of new facts, once per batch id.

    Version ``batch`` is always the last version below it plus ``delta``, so a
    batch that runs twice writes the same rows again, and one that stopped half
    way leaves the version below as the latest. The version that was merged
    stays for those who read it; older ones are deleted.
    """
    below = [v for v in written_versions(spark, base) if v < batch]
    summary = delta
    if below:
        old = spark.read.schema(delta.schema).parquet(f"{base}/version={below[-1]}")
        summary = merge_summaries(old, delta, keys, sums, sketched)
    path = f"{base}/version={batch}"
    unique_by(summary.select(*keys, *sums, *sketched), keys).write.mode("overwrite").parquet(path)
    for version in below[:-1]:
        delete_folder(spark, f"{base}/version={version}")
    return path


def apply_batches(
    summarise: Callable[[DataFrame], DataFrame], base: str, keys: Sequence[str] = KEYS,
    sums: Sequence[str] = SUMS, sketched: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keeps the summary in ``base`` up to date with a stream of facts.

    ``summarise`` gives the summary of some facts. Checkpoint and batch ids
    make each fact count exactly once.
    """

    def save(facts: DataFrame, batch: int) -> None:
        refresh_batch(facts.sparkSession, base, batch, summarise(facts), keys, sums, sketched)

    return save


def latest_summary(spark: SparkSession, base: str) -> DataFrame:
    """The summary with every batch that has been merged."""
    versions = written_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no summary has been written to {base}")
    return spark.read.parquet(f"{base}/version={versions[-1]}")
