"""Sinks and layouts. The number of files follows from the data, never from a
fixed count: where files must be merged or split, AQE sizes the partitions of a
rebalance, hot ones included."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Years with a partition in the warehouse.
FIRST_YEAR, LAST_YEAR = 2020, 2024
SOURCE_SYSTEM = "CRM_SYSTEM"
# Rows of a clustered file, and the least for which a further task is worth it.
FILE_ROWS = 4_000_000
LEAST_FILE_ROWS = 10_000


def stage_append(
    df: DataFrame,
    path: str,
    loaded_at: datetime.datetime | None = None,
    source_system: str | None = SOURCE_SYSTEM,
) -> None:
    """Append to a staging table with its audit columns."""
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    staged = df.withColumn("load_timestamp", stamp)
    if source_system is not None:
        staged = staged.withColumn("source_system", F.lit(source_system))
    staged.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").options(header=True, **options).csv(path)


def write_parquet(df: DataFrame, path: str, compact: bool = False) -> None:
    """Overwrite a Parquet table. ``compact`` shuffles many small partitions
    into files of AQE's advisory size; otherwise nothing is shuffled."""
    rows = df.hint("rebalance") if compact else df
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, kind: str = "parquet") -> dict[str, int]:
    """Overwrite several tables; returns the rows written per table, counted
    while they are written."""
    rows = {}
    for name, df in tables.items():
        seen = Observation(f"rows_{name}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if kind == "csv":
            write_csv(counted, f"{folder}/{name}.csv")
        else:
            write_parquet(counted, f"{folder}/{name}")
        rows[name] = seen.get["rows"]
    return rows


def unload(df: DataFrame, path: str) -> None:
    """Export a query result as Parquet, replacing an earlier export."""
    df.write.mode("overwrite").parquet(path)


def split_by_year(
    df: DataFrame, key: str, first: int = FIRST_YEAR, last: int = LAST_YEAR
) -> tuple[DataFrame, DataFrame]:
    """``(rows with a partition, rows without one)``; adds ``year`` from a
    YYYYMMDD key. A null key has no partition."""
    dated = df.withColumn("year", F.floor(F.col(key) / 10000).cast("int"))
    inside = F.coalesce(F.col("year").between(first, last), F.lit(False))
    return dated.filter(inside), dated.filter(~inside)


def write_by_year(df: DataFrame, path: str) -> None:
    """One folder per ``year``, so that a filter on it prunes the others."""
    df.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)


def write_clustered(
    df: DataFrame, path: str, cluster: Sequence[str], tie: Sequence[str], file_rows: int = FILE_ROWS
) -> None:
    """Files of about ``file_rows`` rows sorted by ``cluster``: narrow value
    ranges per row group, which a filter skips. ``tie`` lets one value span
    many files. The rows are counted first, so their number sets that of the files."""
    order = [*cluster, *tie]
    wished = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.count()
    files = max(1, -(-rows // file_rows), min(wished, -(-rows // LEAST_FILE_ROWS)))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_run_stats(
    spark: SparkSession, path: str, status: str, started: datetime.datetime,
    duration: float, rows: Mapping[str, int], error: str | None = None,
) -> None:
    """The record of a run, as one JSON row."""
    spark.createDataFrame(
        [(status, started, round(duration, 2), dict(rows), error)],
        "status string, run_timestamp timestamp, duration_sec double, "
        "rows_loaded map<string,bigint>, error string",
    ).write.mode("overwrite").json(path)
