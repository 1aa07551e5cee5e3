"""Reading a table as it was, from a change log or from written snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    until: Column,
    deleted: Column | None = None,
) -> DataFrame:
    """Latest row per key among the log rows that satisfy ``until``.

    ``version`` orders the changes of a key. Keys whose latest row satisfies
    ``deleted`` are absent. A key with any number of changes costs one row per
    task, since the maximum combines map-side.
    """
    values = [c for c in log.columns if c not in keys]
    latest = (
        log.filter(until)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*version)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*log.columns)
    )
    return latest if deleted is None else latest.filter(~deleted)


def before_statement(
    log: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    statement: str,
    statement_id,
    deleted: Column | None = None,
) -> DataFrame:
    """The table just before the statement with the given id changed it."""
    return as_of(log, keys, version, F.col(statement) < F.lit(statement_id), deleted)


def offset_bound(column: str, now: Column, seconds: int) -> Column:
    """Condition for ``as_of``: changes up to ``seconds`` (negative) from now."""
    return F.col(column) <= now + F.make_dt_interval(secs=F.lit(seconds))


def write_snapshot(df: DataFrame, base: str, version: int) -> str:
    """Write a version of the table next to the others; none is overwritten."""
    path = f"{base}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, base: str, version: int) -> DataFrame:
    """A table pinned to one version: a clone that shares the files."""
    return spark.read.parquet(f"{base}/version={version}")
