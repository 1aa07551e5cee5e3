"""Shared scratch storage.

Intermediate results that more than one job must see unchanged (row
positions, for example) are written as Parquet tables under the folder the
cluster names in ``spark.checkpoint.dir``. A written table survives the loss
of executors and is read back with column pruning.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


# Bytes of a scan per core up to which its rows are dealt out anew.
SPREAD_BYTES = 32 * 1024 * 1024

_fallback: dict[str, str] = {}
# The folder of the innermost ``scratch`` block.
_owner: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder for scratch tables, from ``spark.checkpoint.dir``.

    Only a session on a local master may run without the setting: it gets a
    temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that every executor can reach"
        )
    if context.applicationId not in _fallback:
        _fallback[context.applicationId] = tempfile.mkdtemp(prefix="sparkclaims-")
    return _fallback[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of this application that no other call gets."""
    return f"{_owner.get() or _application_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Owns the scratch tables written inside: they are deleted at its end.

    Write or collect a result before leaving the block; it may read them.
    """
    folder = f"{_application_dir(spark)}/scratch-{uuid.uuid4().hex}"
    before = _owner.set(folder)
    try:
        yield folder
    finally:
        _owner.reset(before)
        delete_folder(spark, folder)


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sparkclaims/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once and return the written table (cuts the lineage)."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A few rows as part of the plan: no Python worker reads them, and
    Catalyst knows their size."""
    return spark.createDataFrame(pa.table(columns), schema)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``; near its files' for a scan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame) -> DataFrame:
    """Rows over every core, for costly row work on a scan of few files.

    Only a small input is shuffled, at most ``SPREAD_BYTES`` of it to a task. The
    files of a larger one are split by Spark, which takes it to more than one
    task per core in any case.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or estimated_bytes(df) > cores * SPREAD_BYTES:
        return df
    return df.repartition(cores)


def release_scratch(spark: SparkSession) -> bool:
    """Delete the scratch tables of this application.

    Call it at the end, when no returned DataFrame is read any more.
    """
    return delete_folder(spark, _application_dir(spark))


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def written_versions(spark: SparkSession, base: str, name: str = "version") -> list[int]:
    """The numbers n of the folders ``<name>=n`` in ``base`` whose write has ended, ascending.

    A folder that a lost driver left half written is not among them.
    """
    path, files = _path(spark, base)
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        prefix, _, number = status.getPath().getName().partition("=")
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if prefix == name and number.isdigit() and files.exists(marker):
            found.append(int(number))
    return sorted(found)


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder with all its files; False if there is none."""
    path, files = _path(spark, folder)
    return files.delete(path, True)


def publish(spark: SparkSession, written: str, folder: str) -> None:
    """Put a written folder in the place of ``folder`` (a rename, no copy)."""
    path, files = _path(spark, written)
    target, _ = _path(spark, folder)
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(path, target):
        raise OSError(f"{written} could not be renamed to {folder}")
