"""Documents as shredded variants: a read of one path scans its column only."""

from __future__ import annotations

import glob

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import semistructured as docs
from sparkclaims.sources import variants


@pytest.fixture
def stored(spark, tmp_path):
    texts = spark.range(5_000).selectExpr(
        """CASE WHEN id = 7 THEN 'cut {' WHEN id = 8 THEN '{"metadata": {"odd": [1]}}'
           ELSE to_json(named_struct('metadata', named_struct('status', concat('s', id % 3), 'note', repeat(sha2(CAST(id AS STRING), 256), 8)),
                                     'financial', named_struct('claimed_amount', id / 4))) END AS document""",
        "id",
    )
    path = str(tmp_path / "documents")
    variants.write_documents(docs.parse_variant(texts.coalesce(1), F.col("document")).select("id", "raw_json"), path)
    return path


PATHS = {"status": ("$.metadata.status", "string"), "claimed": ("$.financial.claimed_amount", "double")}


def test_values_are_the_same_as_before_writing(spark, stored):
    found = docs.extract_paths(variants.read_documents(spark, stored), "raw_json", PATHS, ["id"]).collect()
    by_id = {r["id"]: (r["status"], r["claimed"]) for r in found}
    assert by_id[9] == ("s0", 2.25) and by_id[7] == (None, None) and by_id[8] == (None, None) and len(by_id) == 5_000


def test_a_path_is_a_column_and_the_scan_asks_for_no_other(spark, stored):
    found = docs.extract_paths(variants.read_documents(spark, stored), "raw_json", {"status": PATHS["status"]}, [])
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert "raw_json:struct<0:string>" in scan
    meta = parquet.ParquetFile(glob.glob(f"{stored}/*.parquet")[0]).metadata
    sizes = {}
    for group in range(meta.num_row_groups):
        for at in range(meta.num_columns):
            column = meta.row_group(group).column(at)
            sizes[column.path_in_schema] = sizes.get(column.path_in_schema, 0) + column.total_compressed_size
    of_path = sum(size for name, size in sizes.items() if name.endswith(("status.typed_value", "status.value")) or name in ("raw_json.metadata", "raw_json.value", "raw_json.typed_value.metadata.value"))
    assert any("status.typed_value" in name for name in sizes) and of_path < 0.1 * sum(sizes.values())


def test_without_the_settings_nothing_is_written(spark, tmp_path):
    df = docs.parse_variant(spark.createDataFrame([("{}",)], "t string"), F.col("t"))
    spark.conf.set(variants.WRITE_SETTINGS[0], "false")
    try:
        with pytest.raises(ValueError, match="writeShredding"):
            variants.write_documents(df, str(tmp_path / "x"))
    finally:
        spark.conf.set(variants.WRITE_SETTINGS[0], "true")
