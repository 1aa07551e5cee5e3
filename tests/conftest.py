from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans are read as text: paths of any temp folder must be whole.
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are when no table is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def many_blocks(spark):
    """Keeps AQE from merging the small partitions of a test."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda row: [(v is not None, v if v is not None else 0) for v in row],
        )

    return collect
