from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text[, source]) rows."""

    def build(*rows):
        whole = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(whole, SCHEMA)

    return build


@pytest.fixture
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}
