"""A table of changes that is read as of any version: bases and the tail after them.

Every commit writes its changes to a folder of its number. From time to time
the whole table is written as a base. A read takes the nearest base at or
before the version it wants and folds only the commits after it; folders
before the base are never listed into the scan. A manifest, one row per
commit, tells which version a time or a statement stands for.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.operators.joins import join_null_safe, unique_by
from sparkclaims.storage import delete_folder, local_table, written_versions

_MANIFEST = "committed_at timestamp_ntz, statement string, kind string, origin string, origin_version long"
CHANGES, RESTORE, CLONE = "changes", "restore", "clone"


@dataclass(frozen=True)
class VersionedTable:
    """The table in the folder ``base``, one row per ``keys``.

    A change is a whole row with its last column ``deleted`` (true removes the
    key). Commits are numbered from 0 and made by one writer at a time.
    """

    base: str
    schema: T.StructType
    keys: tuple[str, ...]

    # Writing

    def commit(self, changes: DataFrame, at: datetime.datetime, statement: str | None = None) -> int:
        """Write a set of changes as the next version; a repeated key raises.

        ``changes`` may have a boolean column ``deleted``. The commit counts
        once its manifest entry is written, so a failed one is written again.
        """
        spark = changes.sparkSession
        rows = changes if "deleted" in changes.columns else changes.withColumn("deleted", F.lit(False))
        rows = rows.select(*self.schema.names, F.coalesce("deleted", F.lit(False)).alias("deleted"))
        version = self._next(spark, at)
        unique_by(rows, self.keys).write.mode("overwrite").parquet(f"{self.base}/changes/version={version}")
        return self._enter(spark, version, at, statement, CHANGES)

    def checkpoint(self, spark: SparkSession, version: int | None = None) -> int:
        """Write the table as of ``version`` (the last one) as a base for later reads."""
        version = self.last(spark) if version is None else version
        self.read(spark, version).write.mode("overwrite").parquet(f"{self.base}/bases/version={version}")
        return version

    def restore(self, spark: SparkSession, version: int, at: datetime.datetime, statement: str | None = None) -> int:
        """A new version with the rows of an earlier one; what lies between stays readable."""
        number = self._next(spark, at)
        self.read(spark, version).write.mode("overwrite").parquet(f"{self.base}/bases/version={number}")
        return self._enter(spark, number, at, statement, RESTORE)

    def clone(self, spark: SparkSession, target: str, at: datetime.datetime, version: int | None = None) -> VersionedTable:
        """A table whose version 0 is this one's: no row is copied, and neither sees the other's later changes."""
        copy = VersionedTable(target, self.schema, self.keys)
        if written_versions(spark, f"{target}/manifest"):
            raise ValueError(f"{target} holds a table already")
        copy._enter(spark, 0, at, None, CLONE, self.base, self.last(spark) if version is None else version)
        return copy

    def forget(self, spark: SparkSession, before: int) -> list[int]:
        """Delete the commits up to the last base at or below ``before``; versions under that base can no
        longer be read. Clones of those versions must be gone. Returns the versions deleted."""
        bases = [v for v in written_versions(spark, f"{self.base}/bases") if v <= before]
        if not bases:
            return []
        gone = [v for v in written_versions(spark, f"{self.base}/changes") if v <= bases[-1]]
        for version in gone:
            delete_folder(spark, f"{self.base}/changes/version={version}")
        for version in bases[:-1]:
            delete_folder(spark, f"{self.base}/bases/version={version}")
        return gone

    # Reading

    def last(self, spark: SparkSession) -> int:
        versions = written_versions(spark, f"{self.base}/manifest")
        if not versions:
            raise LookupError(f"no version has been committed to {self.base}")
        return versions[-1]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """version, committed_at, statement, kind and origin of every commit."""
        schema = T._parse_datatype_string(f"{_MANIFEST}, version long")
        rows = spark.read.schema(schema).parquet(f"{self.base}/manifest")
        return rows.filter(F.col("version") <= self.last(spark))

    def version_at(self, spark: SparkSession, moment: datetime.datetime) -> int:
        """The last version committed at ``moment`` or before."""
        return self._one(spark, F.max("version"), F.col("committed_at") <= F.lit(moment).cast("timestamp_ntz"), moment)

    def version_before(self, spark: SparkSession, statement: str) -> int:
        """The version that the statement found."""
        return self._one(spark, F.min("version") - 1, F.col("statement") == statement, statement)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows as of a version (the last one).

        Rows of the base whose key has no later change are taken as they are;
        only the tail is folded, so the work grows with what was changed.
        """
        version = self.last(spark) if version is None else version
        if not 0 <= version <= self.last(spark):
            raise LookupError(f"{self.base} has no version {version}")
        start, rows = self._start(spark, version)
        tail = [v for v in range(start + 1, version + 1)]
        if not tail:
            return rows
        latest = self._tail(spark, start, version).groupBy(*self.keys).agg(
            F.max_by(F.struct(*self._values(), "deleted"), "version").alias("_row")
        )
        kept = join_null_safe(rows, latest.select(*self.keys), list(self.keys), "left_anti")
        return kept.unionByName(latest.select(*self.keys, "_row.*").filter(~F.col("deleted")).select(*self.schema.names))

    def changes(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """The changes of the versions from ``after`` (left out) to ``upto``."""
        return self._tail(spark, after, upto)

    def _tail(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField("deleted", T.BooleanType()), T.StructField("version", T.LongType())])
        folders = [f"{self.base}/changes/version={v}" for v in written_versions(spark, f"{self.base}/changes") if after < v <= upto]
        if not folders:
            return spark.createDataFrame([], whole)
        # Only these folders are listed, however many lie before them.
        return spark.read.schema(whole).option("basePath", f"{self.base}/changes").parquet(*folders)

    def _start(self, spark: SparkSession, version: int) -> tuple[int, DataFrame]:
        """The nearest base at or before ``version`` and its rows; -1 and none without a base."""
        bases = [v for v in written_versions(spark, f"{self.base}/bases") if v <= version]
        if bases:
            return bases[-1], spark.read.schema(self.schema).parquet(f"{self.base}/bases/version={bases[-1]}")
        first = self.manifest(spark).filter("version = 0").first()
        if first["kind"] == CLONE:
            return 0, VersionedTable(first["origin"], self.schema, self.keys).read(spark, first["origin_version"])
        if written_versions(spark, f"{self.base}/changes")[:1] != [0]:
            raise LookupError(f"version {version} of {self.base} has been forgotten")
        return -1, spark.createDataFrame([], self.schema)

    def _values(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.keys]

    def _one(self, spark: SparkSession, version, condition, asked) -> int:
        found = self.manifest(spark).filter(condition).agg(version.alias("version")).first()["version"]
        if found is None or found < 0:
            raise LookupError(f"{self.base} has no version for {asked}")
        return found

    def _next(self, spark: SparkSession, at: datetime.datetime) -> int:
        done = written_versions(spark, f"{self.base}/manifest")
        if done:
            earlier = self.manifest(spark).agg(F.max("committed_at")).first()[0]
            if at < earlier:
                raise ValueError(f"a commit at {at} would come before the last one, at {earlier}")
        return done[-1] + 1 if done else 0

    def _enter(
        self, spark: SparkSession, version: int, at: datetime.datetime, statement: str | None, kind: str,
        origin: str | None = None, origin_version: int | None = None,
    ) -> int:
        entry = {"committed_at": [at], "statement": [statement], "kind": [kind], "origin": [origin], "origin_version": [origin_version]}
        local_table(spark, entry, _MANIFEST).write.mode("overwrite").parquet(f"{self.base}/manifest/version={version}")
        return version
