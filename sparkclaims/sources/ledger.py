"""Bulk loads that take each file once.

A ledger holds the identity of every file that was loaded: path, size and time
of its last change. A load lists the files, leaves out what the ledger holds,
and reads the others only. Rows, rejected rows and ledger entries of a load
stand in folders of its number; the entries are written last, and only loads
with entries are read. So a load that dies half way has not happened, and the
next one takes its number and its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.sources.readers import copy_into
from sparkclaims.storage import materialize, written_versions

#: What happens to a file with rejected rows: its good rows are loaded, or none of them.
CONTINUE, SKIP_FILE = "continue", "skip_file"
#: Files whose paths the driver hands to one load.
FILES_PER_LOAD = 10_000

_IDENTITY = ["file", "size", "changed_at"]
_ENTRY = "file string, size long, changed_at timestamp, status string, rows_loaded long, rows_rejected long"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """file, size and changed_at of the files below ``folder``, and the path to
    read each by; their content is not read."""
    found = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed_at"), "path",
    )


@dataclass(frozen=True)
class LoadLedger:
    """The loads of one target table in the folder ``base``."""

    base: str
    schema: T.StructType

    def entries(self, spark: SparkSession) -> DataFrame:
        """One row per load and file."""
        schema = T._parse_datatype_string(f"{_ENTRY}, load long")
        if not self.loads(spark):
            return spark.createDataFrame([], schema)
        return self._of_loads(spark, spark.read.schema(schema).parquet(f"{self.base}/ledger"))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The loaded rows, with the number of their load."""
        return self._read(spark, "rows", self.schema)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """The rejected rows as text, with their file, the columns at fault and the load."""
        texts = [T.StructField(f.name, T.StringType()) for f in self.schema.fields]
        more = [T.StructField("line", T.StringType()), T.StructField("bad_columns", T.ArrayType(T.StringType()))]
        return self._read(spark, "rejected", T.StructType([*texts, *more, T.StructField("file", T.StringType())]))

    def loads(self, spark: SparkSession) -> list[int]:
        return written_versions(spark, f"{self.base}/ledger", "load")

    def new_files(self, spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
        """Files that no load has taken; one that was changed since is new."""
        known = self.entries(spark).select(*_IDENTITY)
        return list_files(spark, folder, pattern).join(known, _IDENTITY, "left_anti")

    def load(
        self, spark: SparkSession, folder: str, pattern: str = "*.csv", on_error: str = CONTINUE, files_per_load: int = FILES_PER_LOAD
    ) -> list[int]:
        """Load what is new in ``folder``; the numbers of the loads, none when nothing was new.

        With ``SKIP_FILE`` a file with a rejected row loads none of its rows;
        it is entered all the same, and taken again once it changes.
        """
        if on_error not in (CONTINUE, SKIP_FILE):
            raise ValueError(f"on_error is {CONTINUE} or {SKIP_FILE}, not {on_error}")
        done = []
        while True:
            files = materialize(self.new_files(spark, folder, pattern).orderBy("changed_at", "file").limit(files_per_load), "files")
            # Only paths, and no more than one load may read.
            paths = [r["path"] for r in files.select("path").collect()]
            if not paths:
                return done
            done.append(self._load(files, paths, on_error))

    def _load(self, files: DataFrame, paths: list[str], on_error: str) -> int:
        spark = files.sparkSession
        number = max(self.loads(spark), default=-1) + 1
        good, rejected = copy_into(spark, paths, self.schema, "file")
        rejected.write.mode("overwrite").parquet(f"{self.base}/rejected/load={number}")
        faults = spark.read.schema(rejected.schema).parquet(f"{self.base}/rejected/load={number}")
        bad = materialize(faults.groupBy("file").agg(F.count("*").alias("rows_rejected")), "bad-files")
        if on_error == SKIP_FILE:
            good = good.join(bad, "file", "left_anti")
        good.write.mode("overwrite").parquet(f"{self.base}/rows/load={number}")
        loaded = spark.read.schema(good.schema).parquet(f"{self.base}/rows/load={number}")
        counts = loaded.groupBy("file").agg(F.count("*").alias("rows_loaded"))
        zero = F.lit(0).cast("long")
        entries = files.join(counts, "file", "left").join(bad, "file", "left").select(
            *_IDENTITY,
            F.when(F.coalesce("rows_rejected", zero) == 0, "loaded")
            .when(F.coalesce("rows_loaded", zero) > 0, "partly loaded")
            .otherwise("failed").alias("status"),
            F.coalesce("rows_loaded", zero).alias("rows_loaded"),
            F.coalesce("rows_rejected", zero).alias("rows_rejected"),
        )
        entries.write.mode("overwrite").parquet(f"{self.base}/ledger/load={number}")
        return number

    def _of_loads(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """Loads end in order, so all up to the last entered one are whole."""
        return rows.filter(F.col("load") <= max(self.loads(spark)))

    def _read(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField("load", T.LongType())])
        if not self.loads(spark):
            return spark.createDataFrame([], whole)
        return self._of_loads(spark, spark.read.schema(whole).parquet(f"{self.base}/{part}"))
