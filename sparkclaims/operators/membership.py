"""Which keys of a new load are in the table already, without reading all of it for each.

A membership filter has a few bits per loaded key. It lets every loaded key
pass and few others, so an exact join against the large table has to look for
little more than the true repeats. The filter is a table of bitmaps, built by
an aggregate that combines in tasks, and filters of several loads merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.operators.joins import join_null_safe
from sparkclaims.storage import materialize

#: Bits of one bitmap, bits set per key, and bits per key that a filter is made for.
BITMAP_BITS, PROBES, BITS_PER_KEY = 32_768, 3, 12


def buckets_for(keys: int) -> int:
    """Bitmaps of a filter for so many keys."""
    return max(1, -(-keys * BITS_PER_KEY // BITMAP_BITS))


def false_share(keys: int, buckets: int) -> float:
    """The expected share of keys that are not loaded and pass all the same."""
    return (1 - (1 - 1 / BITMAP_BITS) ** (PROBES * keys / buckets)) ** PROBES


@dataclass(frozen=True)
class MembershipFilter:
    """Bitmaps in the folder ``path``, of keys from the columns ``keys`` (null is a value of its own).

    All filters that are to merge have the same ``buckets``.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int

    def _hash(self, seed: int) -> Column:
        """A hash of the key's values and of which of them are null."""
        present = [F.col(k).isNull() for k in self.keys]
        return F.xxhash64(F.lit(seed), *present, *[F.col(k) for k in self.keys])

    def _bucket(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.buckets)).cast("int")

    def _bits(self) -> list[Column]:
        return [F.pmod(self._hash(n + 1), F.lit(BITMAP_BITS)) for n in range(PROBES)]

    def add(self, rows: DataFrame) -> None:
        """Add the keys of ``rows``; adding them again changes nothing."""
        bits = rows.select(self._bucket().alias("bucket"), F.explode(F.array(*self._bits())).alias("_bit"))
        made = bits.groupBy("bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        made.write.mode("append").parquet(self.path)

    def bitmaps(self, spark: SparkSession) -> DataFrame:
        """One row per bucket with a key; parts that were added apart are joined by OR."""
        parts = spark.read.schema("bucket int, bits binary").parquet(self.path)
        return parts.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def passing(self, rows: DataFrame) -> DataFrame:
        """The rows whose key may have been added: all that were, and few others.

        Each row meets one bitmap. A repeated key lies in one bucket, so hand
        in distinct keys when some are frequent.
        """
        bitmaps = self.bitmaps(rows.sparkSession).withColumnRenamed("bucket", "_bucket")

        def is_set(bit: Column) -> Column:
            byte = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, (bit % 8).cast("int")) == 1

        found = rows.withColumn("_bucket", self._bucket()).join(bitmaps, "_bucket")
        condition = is_set(self._bits()[0])
        for bit in self._bits()[1:]:
            condition = condition & is_set(bit)
        return found.filter(condition).select(*rows.columns)


def repeats_across_loads(incoming: DataFrame, loaded: DataFrame, known: MembershipFilter) -> DataFrame:
    """keys, ``rows`` and ``rows_loaded`` of every key of ``incoming`` that ``loaded`` holds; exact.

    ``known`` has the keys of ``loaded``. The distinct incoming keys are
    written, probed, and only what passes is looked for in the large table,
    which is read once, its key columns only, and summed before the join.
    """
    keys = list(known.keys)
    arriving = materialize(incoming.groupBy(*keys).agg(F.count("*").alias("rows")), "arriving")
    # Written, so that Catalyst knows how few they are.
    suspects = materialize(known.passing(arriving), "suspects")
    wanted = join_null_safe(loaded.select(*keys), suspects.select(*keys), keys, "left_semi")
    there = wanted.groupBy(*keys).agg(F.count("*").alias("rows_loaded"))
    return join_null_safe(suspects, there, keys, "inner")
