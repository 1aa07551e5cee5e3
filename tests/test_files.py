from __future__ import annotations

import datetime
import gzip
import json
import os
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sparkclaims import schemas, storage
from sparkclaims.bindings import files as bound
from sparkclaims.bindings.tables import Tables
from sparkclaims.plans import etl
from sparkclaims.sources import readers, writers
from sparkclaims.storage import scratch_path, shared_dir

AS_OF = datetime.date(2024, 6, 30)


class Session:
    """As much of a session as the choice of a folder needs."""

    def __init__(self, master, settings):
        self.conf, self.sparkContext = settings, self
        self.master, self.applicationId = master, f"app-{master}"


def test_shared_folder():
    named = Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(named) == "hdfs:///shared"
    local = Session("local[2]", {})
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn", {}))


def test_release_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_application_dir", lambda _: str(tmp_path / "app"))
    table = storage.materialize(spark.range(3), "t")
    assert table.count() == 3
    assert storage.release_scratch(spark)
    assert not (tmp_path / "app").exists()


def test_compact_write(spark):
    path = scratch_path(spark, "compact")
    writers.write_parquet(spark.range(100).repartition(20), path, compact=True)
    read = spark.read.parquet(path)
    assert read.count() == 100 and len(read.inputFiles()) < 20


def test_read_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("agent_id,agent_name,region,experience_years,performance_rating\nA1,\"Doe, J\",North,3,4.5\n")
    row = readers.read_csv(spark, str(tmp_path / "a.csv"), schemas.AGENTS).first()
    assert tuple(row) == ("A1", "Doe, J", "North", 3, D("4.5"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_csv(spark, str(tmp_path / "none.csv"), schemas.AGENTS)


SCHEMA = schemas.table(id=schemas.INT, name=schemas.STRING, amount=schemas.MONEY, day=schemas.DATE)


def test_copy_into(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text(
        "id,name,amount,day\n"
        '1,"a, b",1.50,2024-01-02\n'
        "2,NULL,null,\n"
        '3,"say ""hi""",2,2024-01-03\n'
        "four,x,1,2024-01-01\n"
        "5,x,1\n"
        "6,x,1,2024-01-01,more\n"
        "7,x,1,soon\n"
    )
    good, rejected = readers.copy_into(spark, str(tmp_path / "x.csv"), SCHEMA)
    assert rows(good) == [
        (1, "a, b", D("1.50"), datetime.date(2024, 1, 2)),
        (2, None, None, None),
        (3, 'say "hi"', D("2.00"), datetime.date(2024, 1, 3)),
    ]
    assert rows(rejected, "id", "bad_columns") == [("5", []), ("6", []), ("7", ["day"]), ("four", ["id"])]


def document(i):
    return {
        "claim_id": f"C{i}",
        "metadata": {"claim_type": "Fire", "status": "Pending", "fraud_indicators": {"is_fraud": i % 2 == 0, "fraud_score": 0.5, "flags": ["x"] * (i % 3)}},
        "financial": {"claimed_amount": 1.0, "approved_amount": 0.5, "processing_days": i},
    }


def test_json_array_and_variants(spark, tmp_path):
    path = tmp_path / "claims.json"
    path.write_text(json.dumps([document(i) for i in range(5)], indent=2))
    read = readers.read_json_array(spark, str(path))
    assert read.schema == schemas.CLAIM_DOCUMENT
    assert read.agg(F.sum("financial.processing_days")).first()[0] == 10
    variants = readers.read_variant_array(spark, str(path))
    assert variants.count() == 5
    lines = tmp_path / "lines.json"
    lines.write_text(json.dumps(document(1)) + "\n{broken\n")
    loaded = readers.read_variant_lines(spark, str(lines))
    assert loaded.filter("raw_json IS NULL").count() == 1


def test_stage_append(spark):
    path = scratch_path(spark, "stage")
    moment = datetime.datetime(2024, 1, 1, 6)
    for _ in range(2):
        writers.stage_append(spark.range(2), path, moment)
    writers.stage_append(spark.range(1), path, moment, source_system=None)
    staged = spark.read.parquet(path)
    assert staged.count() == 5
    assert set(staged.columns) >= {"id", "load_timestamp"}


def test_years(spark, rows):
    keys = [20191231, 20200101, 20241231, 20250101, None]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    inside, outside = writers.split_by_year(df, "k")
    assert rows(inside, "k", "year") == [(20200101, 2020), (20241231, 2024)]
    assert outside.count() == 3
    path = scratch_path(spark, "years")
    writers.write_by_year(inside, path)
    read = spark.read.parquet(path).filter("year = 2020")
    filters = read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert re.search(r"\(year#\d+ = 2020\)\]", filters)
    assert rows(read, "k") == [(20200101,)]


def test_clustered_files_split_a_hot_value(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(20_000).select(F.lit(20240101).alias("day"), F.lit("a").alias("kind"), "id").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_clustered(df, path, ["day", "kind"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.parquet(path).inputFiles()) > 1


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()

    def save(name, header, *lines):
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    save("dim_customers", ",".join(schemas.CUSTOMERS.names),
         "CUST1,Ann,A,30,Female,Single,Employed,50000,700,Pune,Delhi,2019-01-01",
         "CUST2,Bob,,80,,,Retired,0,300,Pune,Delhi,2019-01-02")
    save("fact_policies", ",".join(schemas.POLICIES.names),
         "POL1,CUST1,PT1,AGT1,2023-01-01,2024-01-01,100.00,1000,50,Active,2.50",
         "POL2,CUST2,PT1,AGT1,2023-02-01,2024-02-01,100.00,1000,50,Lapsed,3.50")
    save("fact_claims", ",".join(schemas.CLAIMS.names),
         "CLM1,POL1,2023-05-01,Fire,100.00,50.00,Approved,1,0.9000,10,note,20230501",
         "CLM2,POL9,2023-06-01,Fire,200.00,300.00,Pending,0,0.1000,20,note,20230601")
    save("dim_agents", ",".join(schemas.AGENTS.names), "AGT1,Joe,North,5,4.5")
    save("dim_policy_types", ",".join(schemas.POLICY_TYPES.names), "PT1,Auto Insurance,Vehicle,0.05,500000")
    save("dim_date", ",".join(schemas.DATES.names), "20230501,2023-05-01,2023,2,5,May,18,0,Monday,0,0")
    return folder


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_batch_load(spark, source, tmp_path, kind, rows):
    target = str(tmp_path / "out")
    written = etl.run(spark, str(source), target, AS_OF, kind)
    assert written == {
        "dwh_dim_customers": 2, "dwh_fact_policies": 2, "dwh_fact_claims": 2,
        "dwh_dim_agents": 1, "dwh_dim_policy_type": 1, "dwh_dim_date": 1,
    }
    log = spark.read.json(f"{target}/run_log").first()
    assert log["status"] == "SUCCESS" and log["rows_loaded"]["dwh_fact_claims"] == 2
    if kind == "csv":
        return
    customers = spark.read.parquet(f"{target}/dwh_dim_customers")
    assert rows(customers, "customer_key", "age_band", "income_band", "credit_band", "gender", "full_name", "is_current") == [
        (1, "26-35", "Medium", "Good", "Female", "Ann A", True),
        (2, "65+", None, "Poor", "Unknown", None, True),
    ]
    claims = spark.read.parquet(f"{target}/dwh_fact_claims")
    shown = ["claim_id", "payout_ratio", "rejected_amount", "risk_score", "policy_risk_score", "date_id", "fraud_flag", "load_date"]
    assert rows(claims, *shown) == [
        ("CLM1", 0.5, D("50.00"), 0.7, D("2.50"), 20230501, True, AS_OF),
        ("CLM2", 1.5, D("-100.00"), 0.55, None, 20230601, False, AS_OF),
    ]
    policies = spark.read.parquet(f"{target}/dwh_fact_policies")
    assert rows(policies, "start_date_key", "end_date_key", "policy_duration_days")[0] == (20230101, 20240101, 365)


def test_failed_check_stops_the_load(spark, source, tmp_path):
    path = source / "fact_claims.csv"
    lines = path.read_text().splitlines()
    path.write_text("\n".join([*lines, lines[1]]) + "\n")
    target = tmp_path / "out"
    with pytest.raises(ValueError, match="repeat a key"):
        etl.run(spark, str(source), str(target), AS_OF)
    assert [p.name for p in target.iterdir()] == ["run_log"]
    log = spark.read.json(f"{target}/run_log").first()
    assert log["status"] == "FAILED" and "fact_claims" in log["error"]


def test_missing_source_is_recorded(spark, source, tmp_path):
    (source / "dim_agents.csv").rename(source / "other.csv")
    target = str(tmp_path / "out")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        etl.run(spark, str(source), target, AS_OF)
    assert spark.read.json(f"{target}/run_log").first()["status"] == "FAILED"


def test_a_large_scan_is_not_dealt_out_anew(spark, monkeypatch):
    claims = Tables(spark, "/root/testdata/sf0.001").claims
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan(storage.spread(claims))
    monkeypatch.setattr(storage, "SPREAD_BYTES", 1)
    assert "Repartition" not in plan(storage.spread(claims))


def test_arrays_are_dealt_out_before_their_documents_are_made(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bound, "ARRAY_ROWS", 1_000)
    claims = Tables(spark, "/root/testdata/sf0.001").claims
    path = str(tmp_path / "arrays")
    bound.write_arrays(claims, path)
    files = [f for f in os.listdir(path) if f.endswith(".txt.gz")]
    sizes = [len(json.loads(gzip.open(f"{path}/{f}").read())) for f in files]
    assert sum(sizes) == claims.count() and max(sizes) <= 1_000


def test_what_follows_from_a_claim_is_made_after_its_join(spark):
    claims = spark.createDataFrame([], schemas.SOURCE_TABLES["fact_claims"])
    policies = spark.createDataFrame([], schemas.SOURCE_TABLES["fact_policies"])
    loaded = etl.transform_claims(claims, policies, datetime.date(2024, 6, 30))
    assert loaded.columns[-5:] == ["payout_ratio", "rejected_amount", "risk_score", "policy_risk_score", "load_date"]
    plan = loaded._jdf.queryExecution().analyzed().toString()
    assert plan.index("AS payout_ratio") < plan.index("Join LeftOuter")
