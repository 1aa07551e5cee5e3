"""Sources, sinks and layouts; each query writes the given tables and reads them back."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.bindings.registry import query
from sparkclaims.bindings.tables import Tables
from sparkclaims.operators import semistructured as docs
from sparkclaims.plans import etl
from sparkclaims.schemas import DATE, INT, MONEY, SOURCE_TABLES, STRING, table
from sparkclaims.sources import readers, variants, writers
from sparkclaims.sources.ledger import LoadLedger
from sparkclaims.storage import scratch_path, spread

LONG = T.LongType()
POLICY_ROWS = table(
    policy_id=LONG, customer_id=LONG, policy_type_id=STRING, start_date=DATE, premium_amount=MONEY, status=STRING
)
CLAIM_ROWS = table(
    claim_id=STRING, policy_id=LONG, claim_date=DATE, claim_type=STRING,
    claimed_amount=MONEY, processing_days=INT, status=STRING,
)
# Elements per JSON array file.
ARRAY_ROWS = 20_000
# Lines per packed file.
PACKED_ROWS = 1_000_000

# The fixed flags of the test claims, by line number.
FLAGS_SQL = """CASE WHEN line_no >= 6 THEN ['late_filing', 'excessive_amount', 'repeat_claimant']
    WHEN line_no >= 4 THEN ['late_filing', 'excessive_amount'] WHEN line_no >= 2 THEN ['late_filing'] ELSE [] END"""


# What a claim's document is made of.
DOCUMENT_FIELDS = [
    "claim_id", "claim_type", "status", "fraud_flag", "fraud_score", "claimed_amount", "approved_amount",
    "processing_days", "line_no",
]


def document(field: Callable[[str], Column]) -> Column:
    """A test claim as JSON text, from its fields; claims on line 1 have no flags."""
    line = field("line_no")
    flags = F.array_compact(
        F.array(
            F.when(line >= 2, F.lit("late_filing")),
            F.when(line >= 4, F.lit("excessive_amount")),
            F.when(line >= 6, F.lit("repeat_claimant")),
        )
    )
    return docs.build_document(
        field("claim_id"), field("claim_type"), field("status"), field("fraud_flag"),
        field("fraud_score").cast("double"), flags, field("claimed_amount").cast("double"),
        field("approved_amount").cast("double"), field("processing_days"),
    )


def documents(t: Tables) -> DataFrame:
    """The test claims as JSON text."""
    return spread(t.claims).select("claim_id", "line_no", document(F.col).alias("document"))


def stored_documents(t: Tables) -> DataFrame:
    """The table of claims as variants."""
    return docs.parse_variant(documents(t), F.col("document")).select("claim_id", "raw_json")


def write_arrays(claims: DataFrame, path: str) -> None:
    """Files of one JSON array each, with at most ``ARRAY_ROWS`` elements.

    The claims are dealt out by array before their documents are made, which are
    several times as wide; the arrays are gathered where they are written.
    """
    numbered = claims.select(*DOCUMENT_FIELDS).withColumn(
        "_chunk", F.floor(F.monotonically_increasing_id() / ARRAY_ROWS)
    )
    arrays = numbered.repartition("_chunk").groupBy("_chunk").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(document(F.col)), ",\n"), F.lit("]")).alias("value")
    )
    arrays.select("value").write.options(maxRecordsPerFile=1, compression="gzip").text(path)


@query(
    "scan_csv",
    """SELECT policy_id, customer_id, policy_type_id, CAST(start_date AS VARCHAR) AS start_date,
         CAST(premium_amount AS DOUBLE) AS premium_amount, status FROM policies""",
)
def scan_csv(t: Tables):
    path = scratch_path(t.spark, "scan_csv")
    writers.write_csv(t.policies.select(*POLICY_ROWS.names), path)
    return readers.read_csv(t.spark, path, POLICY_ROWS)


@query(
    "scan_json",
    """SELECT claim_type, status, COUNT(*) AS documents, CAST(SUM(fraud) AS BIGINT) AS fraud,
         CAST(SUM(CASE WHEN line_no >= 6 THEN 3 WHEN line_no >= 4 THEN 2 WHEN line_no >= 2 THEN 1
           ELSE 0 END) AS BIGINT) AS flags, CAST(SUM(processing_days) AS BIGINT) AS days
       FROM claims GROUP BY 1, 2""",
)
def scan_json(t: Tables):
    path = scratch_path(t.spark, "scan_json")
    write_arrays(t.claims, path)
    indicators = F.col("metadata.fraud_indicators")
    return (
        readers.read_json_array(t.spark, path)
        .groupBy(F.col("metadata.claim_type").alias("claim_type"), F.col("metadata.status").alias("status"))
        .agg(
            F.count("*").alias("documents"),
            F.count_if(indicators["is_fraud"]).alias("fraud"),
            F.sum(F.size(indicators["flags"])).alias("flags"),
            F.sum("financial.processing_days").alias("days"),
        )
    )


def _dialect_lines(t: Tables, condition: str = "true") -> DataFrame:
    """Claims as CSV lines with quoted commas and every spelling of null; a
    number of them cannot be parsed."""
    line = F.col("line_no")
    status = (
        F.when(line == 3, "NULL").when(line == 4, "null").when(line == 5, "")
        .otherwise(F.concat(F.lit('"'), F.col("status"), F.lit(', noted"')))
    )
    days = F.when(line == 6, "soon").otherwise(F.col("processing_days").cast("string"))
    more = F.when(line == 7, ",extra").otherwise("")
    return t.claims.filter(condition).select(
        F.concat(
            F.concat_ws(",", "claim_id", "policy_id", "claim_date", "claim_type", "claimed_amount", days, status),
            more,
        ).alias("value")
    )


def _copy_into(t: Tables):
    path = scratch_path(t.spark, "copy_into")
    header = ",".join(CLAIM_ROWS.names)
    # Plain text with a header per file: the lines bring their own quotes and commas.
    lines = _dialect_lines(t)
    lines.withColumnRenamed("value", header).write.options(
        header=True, quote="", escape="", emptyValue="", quoteAll=False, sep="\u0001"
    ).csv(path)
    return readers.copy_into(t.spark, path, CLAIM_ROWS)


_STATUS_SQL = "CASE WHEN line_no IN (3, 4, 5) THEN NULL ELSE status || ', noted' END"
_BAD_SQL = "(line_no IN (6, 7))"


@query(
    "copy_into",
    f"""SELECT claim_id, policy_id, CAST(claim_date AS VARCHAR) AS claim_date, claim_type,
         CAST(claimed_amount AS DOUBLE) AS claimed_amount, processing_days, {_STATUS_SQL} AS status
       FROM claims WHERE NOT {_BAD_SQL}""",
)
def copy_into(t: Tables):
    good, _ = _copy_into(t)
    return good


@query(
    "copy_into_rejects",
    f"""SELECT claim_id, line_no = 7 AS wrong_length FROM claims WHERE {_BAD_SQL}""",
)
def copy_into_rejects(t: Tables):
    _, rejected = _copy_into(t)
    return rejected.select("claim_id", F.col("line").isNotNull().alias("wrong_length"))


def _load_twice(t: Tables) -> LoadLedger:
    """Claims of lines 1 to 3 come first and are offered again with the others."""
    path = scratch_path(t.spark, "load_ledger")
    header = ",".join(CLAIM_ROWS.names)
    ledger = LoadLedger(f"{path}/claims", CLAIM_ROWS)
    for number, condition in enumerate(["line_no <= 3", "line_no > 3"]):
        lines = _dialect_lines(t, condition).withColumnRenamed("value", header)
        lines.write.options(header=True, quote="", escape="", emptyValue="", quoteAll=False, sep="\u0001").csv(f"{path}/in/{number}")
        ledger.load(t.spark, f"{path}/in")
        ledger.load(t.spark, f"{path}/in")
    return ledger


@query(
    "load_ledger",
    f"""SELECT CAST(line_no > 3 AS BIGINT) AS load, COUNT(*) FILTER (WHERE NOT {_BAD_SQL}) AS rows_loaded,
         COUNT(*) FILTER (WHERE {_BAD_SQL}) AS rows_rejected FROM claims GROUP BY 1""",
)
def load_ledger(t: Tables):
    """What the files of each load brought; a load that finds nothing new has no number."""
    entries = _load_twice(t).entries(t.spark)
    return entries.groupBy("load").agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


@query(
    "load_ledger_rows",
    f"""SELECT claim_id, {_STATUS_SQL} AS status, CAST(line_no > 3 AS BIGINT) AS load
       FROM claims WHERE NOT {_BAD_SQL}""",
)
def load_ledger_rows(t: Tables):
    return _load_twice(t).rows(t.spark).select("claim_id", "status", "load")


@query(
    "load_variant",
    """SELECT CASE WHEN line_no = 3 THEN NULL ELSE claim_type END AS claim_type,
         line_no = 3 AS malformed, COUNT(*) AS documents,
         CAST(SUM(CASE WHEN line_no = 3 THEN NULL ELSE claimed_amount END) AS DOUBLE) AS claimed
       FROM claims GROUP BY 1, 2""",
)
def load_variant(t: Tables):
    """One document per line; those of line 3 are cut short."""
    path = scratch_path(t.spark, "load_variant")
    text = F.when(F.col("line_no") == 3, F.substring("document", 1, 20)).otherwise(F.col("document"))
    # Packed files are not split, so each is kept short.
    documents(t).select(text.alias("value")).write.options(maxRecordsPerFile=PACKED_ROWS, compression="gzip").text(path)
    loaded = readers.read_variant_lines(t.spark, path)
    amount = F.try_variant_get("raw_json", "$.financial.claimed_amount", "decimal(15,2)")
    return loaded.groupBy(
        F.try_variant_get("raw_json", "$.metadata.claim_type", "string").alias("claim_type"),
        F.col("raw_json").isNull().alias("malformed"),
    ).agg(F.count("*").alias("documents"), F.sum(amount).alias("claimed"))


@query(
    "load_variant_array",
    """SELECT status, COUNT(*) AS documents, CAST(SUM(claimed_amount) AS DOUBLE) AS claimed
       FROM claims GROUP BY 1""",
)
def load_variant_array(t: Tables):
    path = scratch_path(t.spark, "load_variant_array")
    write_arrays(t.claims, path)
    amount = F.try_variant_get("raw_json", "$.financial.claimed_amount", "decimal(15,2)")
    return (
        readers.read_variant_array(t.spark, path)
        .groupBy(F.try_variant_get("raw_json", "$.metadata.status", "string").alias("status"))
        .agg(F.count("*").alias("documents"), F.sum(amount).alias("claimed"))
    )


@query(
    "scan_parquet_field",
    "SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, l_quantity AS quantity FROM lineitem",
)
def scan_parquet_field(t: Tables):
    fields = readers.read_parquet_field(t.spark, f"{t.folder}/lineitem.parquet", "l_shipdate", "l_quantity")
    return fields.select(
        F.col("l_shipdate").cast("date").alias("shipped"), F.col("l_quantity").alias("quantity")
    )


@query(
    "stage_append",
    """SELECT customer_id, age, state, '2024-01-01 06:00:00' AS load_timestamp, 'CRM_SYSTEM' AS source_system
         FROM raw_customers WHERE age < 40
       UNION ALL SELECT customer_id, age, state, '2024-01-02 06:00:00', 'CRM_SYSTEM'
         FROM raw_customers WHERE age >= 40""",
)
def stage_append(t: Tables):
    """Customers under 40 are staged on one day, the others on the next."""
    path = scratch_path(t.spark, "stage_append")
    rows = t.raw_customers.select("customer_id", "age", "state")
    for condition, day in [("age < 40", 1), ("age >= 40 OR age IS NULL", 2)]:
        writers.stage_append(rows.filter(condition), path, datetime.datetime(2024, 1, day, 6, tzinfo=datetime.timezone.utc))
    return t.spark.read.parquet(path)


@query(
    "sink_roundtrip",
    """SELECT 'parquet' AS kind, status, COUNT(*) AS rows, CAST(SUM(premium_amount) AS DOUBLE) AS premium
         FROM policies GROUP BY 2
       UNION ALL SELECT 'csv', status, COUNT(*), CAST(SUM(premium_amount) AS DOUBLE) FROM policies GROUP BY 2""",
)
def sink_roundtrip(t: Tables):
    folder = scratch_path(t.spark, "sink_roundtrip")
    rows = {"policies": t.policies.select(*POLICY_ROWS.names)}
    writers.write_tables(rows, folder, "parquet")
    writers.write_tables(rows, folder, "csv")
    parquet = t.spark.read.parquet(f"{folder}/policies").withColumn("kind", F.lit("parquet"))
    text = readers.read_csv(t.spark, f"{folder}/policies.csv", POLICY_ROWS).withColumn("kind", F.lit("csv"))
    return parquet.unionByName(text).groupBy("kind", "status").agg(
        F.count("*").alias("rows"), F.sum("premium_amount").alias("premium")
    )


@query(
    "unload_filtered",
    """SELECT claim_id, claim_type, CAST(claimed_amount AS DOUBLE) AS claimed_amount
       FROM claims WHERE fraud_flag""",
)
def unload_filtered(t: Tables):
    path = scratch_path(t.spark, "unload")
    writers.unload(t.claims.filter("fraud_flag").select("claim_id", "claim_type", "claimed_amount"), path)
    return t.spark.read.parquet(path)


@query(
    "run_stats",
    """SELECT 'claims' AS table_name, COUNT(*) AS rows_loaded, 'SUCCESS' AS status FROM claims
       UNION ALL SELECT 'customers', COUNT(*), 'SUCCESS' FROM raw_customers
       UNION ALL SELECT 'policies', COUNT(*), 'SUCCESS' FROM policies""",
)
def run_stats(t: Tables):
    folder = scratch_path(t.spark, "run_stats")
    started = datetime.datetime(2024, 1, 1)
    rows = writers.write_tables(
        {"customers": t.raw_customers, "policies": t.policies, "claims": t.claims}, folder
    )
    writers.write_run_stats(t.spark, f"{folder}/run_log", "SUCCESS", started, 0.0, rows)
    log = t.spark.read.schema("status string, rows_loaded map<string,bigint>").json(f"{folder}/run_log")
    return log.select("status", F.explode("rows_loaded").alias("table_name", "rows_loaded"))


@query(
    "partition_pruned_scan",
    """SELECT year(claim_date) AS year, claim_type, COUNT(*) AS claims,
         CAST(SUM(claimed_amount) AS DOUBLE) AS claimed
       FROM claims WHERE year(claim_date) IN (1997, 1999) GROUP BY 1, 2
       UNION ALL SELECT NULL, 'no partition', COUNT(*), CAST(SUM(claimed_amount) AS DOUBLE)
       FROM claims WHERE year(claim_date) NOT BETWEEN 1996 AND 2000""",
)
def partition_pruned_scan(t: Tables):
    """Partitions for 1996 to 2000; two of them are read."""
    path = scratch_path(t.spark, "by_year")
    rows = t.claims.select("date_key", "claim_type", "claimed_amount")
    inside, outside = writers.split_by_year(rows, "date_key", 1996, 2000)
    writers.write_by_year(inside, path)
    figures = [F.count("*").alias("claims"), F.sum("claimed_amount").alias("claimed")]
    read = t.spark.read.parquet(path).filter(F.col("year").isin(1997, 1999))
    rest = outside.agg(*figures).select(
        F.lit(None).cast("int").alias("year"), F.lit("no partition").alias("claim_type"), "claims", "claimed"
    )
    return read.groupBy("year", "claim_type").agg(*figures).unionByName(rest)


@query(
    "clustered_write",
    """SELECT claim_type, COUNT(*) AS claims, CAST(SUM(claimed_amount) AS DOUBLE) AS claimed
       FROM claims WHERE date_key BETWEEN 19980101 AND 19980331 AND claim_type = 'AO' GROUP BY 1""",
)
def clustered_write(t: Tables):
    path = scratch_path(t.spark, "clustered")
    rows = t.claims.select("date_key", "claim_type", "claimed_amount", "policy_id", "line_no", "part_id", "agent_id")
    tie = ["policy_id", "line_no", "part_id", "agent_id", "claimed_amount"]
    writers.write_clustered(rows, path, ["date_key", "claim_type"], tie)
    return (
        t.spark.read.parquet(path)
        .filter(F.col("date_key").between(19980101, 19980331) & (F.col("claim_type") == "AO"))
        .groupBy("claim_type")
        .agg(F.count("*").alias("claims"), F.sum("claimed_amount").alias("claimed"))
    )


@query(
    "json_build",
    f"""SELECT claim_id, claim_type, status, CASE WHEN fraud_flag THEN 'true' ELSE 'false' END AS is_fraud,
         CAST(processing_days AS VARCHAR) AS processing_days, CAST(to_json({FLAGS_SQL}) AS VARCHAR) AS flags FROM claims""",
)
def json_build(t: Tables):
    """The whole document, compared by its fields (numbers print differently elsewhere)."""
    field = lambda path: F.get_json_object("document", path)
    return documents(t).select(
        field("$.claim_id").alias("claim_id"),
        field("$.metadata.claim_type").alias("claim_type"),
        field("$.metadata.status").alias("status"),
        field("$.metadata.fraud_indicators.is_fraud").alias("is_fraud"),
        field("$.financial.processing_days").alias("processing_days"),
        field("$.metadata.fraud_indicators.flags").alias("flags"),
    )


@query(
    "json_extract",
    """SELECT claim_id, claim_id AS claim_id_json, claim_type, status, fraud_flag AS is_fraud,
         CAST(fraud_score AS DOUBLE) AS fraud_score, CAST(claimed_amount AS DOUBLE) AS claimed_amount,
         CAST(approved_amount AS DOUBLE) AS approved_amount FROM claims""",
)
def json_extract(t: Tables):
    return docs.extract_paths(stored_documents(t), "raw_json", docs.CLAIM_PATHS, ["claim_id"])


@query(
    "json_stored",
    """SELECT status, fraud_flag AS is_fraud, COUNT(*) AS documents, CAST(SUM(claimed_amount) AS DOUBLE) AS claimed
       FROM claims GROUP BY 1, 2""",
)
def json_stored(t: Tables):
    """Three paths of documents that were written shredded; no other field is scanned."""
    path = scratch_path(t.spark, "json_stored")
    variants.write_documents(stored_documents(t), path)
    paths = {name: docs.CLAIM_PATHS[name] for name in ("status", "is_fraud")}
    paths["claimed_amount"] = ("$.financial.claimed_amount", "decimal(15,2)")
    typed = docs.extract_paths(variants.read_documents(t.spark, path), "raw_json", paths, [])
    return typed.groupBy("status", "is_fraud").agg(F.count("*").alias("documents"), F.sum("claimed_amount").alias("claimed"))


@query(
    "json_flatten",
    f"""SELECT claim_id, fraud_score, unnest(flags) AS fraud_indicator_flag
       FROM (SELECT claim_id, CAST(fraud_score AS DOUBLE) AS fraud_score, {FLAGS_SQL} AS flags
             FROM claims WHERE fraud_flag)""",
)
def json_flatten(t: Tables):
    fields = {name: docs.CLAIM_PATHS[name] for name in ("is_fraud", "fraud_score")}
    typed = docs.extract_paths(stored_documents(t), "raw_json", fields, ["claim_id", "raw_json"])
    flagged = typed.filter("is_fraud")
    return docs.flatten_flags(
        flagged, "raw_json", ["claim_id", "fraud_score"], "fraud_indicator_flag"
    ).orderBy(F.desc_nulls_first("fraud_score"), "claim_id", "fraud_indicator_flag")


def write_source_files(t: Tables, folder: str) -> None:
    """The test tables as the CSV files that the batch load reads."""
    blank, money = F.lit(None).cast("string"), "decimal(15,2)"
    text = lambda name: F.col(name).cast("string").alias(name)
    customers = t.raw_customers.withColumns(
        {"occupation": blank, "created_date": F.lit(datetime.date(2019, 1, 1))}
    )
    policies = t.policies.withColumns(
        {"agent_id": blank, "deductible_amount": F.lit(50).cast(money)}
    )
    claims = t.claims.withColumns(
        {
            "approved_amount": F.col("approved_amount").cast(money),
            "fraud_flag": F.col("fraud_flag").cast("smallint"),
            "adjuster_notes": blank,
            "date_id": F.col("date_key"),
        }
    )
    agents = t.agents.withColumn("performance_rating", F.lit(4.5).cast("decimal(3,1)"))
    types = t.policy_types.withColumns(
        {
            "base_premium_rate": F.lit(0.05).cast("decimal(6,4)"),
            "max_coverage_amount": F.lit(500000).cast(money),
        }
    )
    dates = t.dates.withColumnRenamed("date_key", "date_id").withColumns(
        {name: F.col(name).cast("smallint") for name in ("is_weekend", "is_holiday")}
    )
    for name, df in {
        "dim_customers": customers, "fact_policies": policies, "fact_claims": claims,
        "dim_agents": agents, "dim_policy_types": types, "dim_date": dates,
    }.items():
        columns = [text(column) for column in SOURCE_TABLES[name].names]
        writers.write_csv(df.select(*columns), f"{folder}/{name}.csv", maxRecordsPerFile=PACKED_ROWS, compression="gzip")


@query(
    "batch_load",
    """WITH c AS (SELECT *, CAST(approved_amount AS DECIMAL(15,2)) AS approved FROM claims)
       SELECT claim_id, round_even(CAST(approved AS DOUBLE) / CAST(claimed_amount AS DOUBLE), 4) AS payout_ratio,
         CAST(claimed_amount - approved AS DOUBLE) AS rejected_amount,
         round_even(CAST(fraud_score AS DOUBLE) * 0.5
           + CAST(claimed_amount AS DOUBLE) / (SELECT CAST(max(claimed_amount) AS DOUBLE) FROM c) * 0.3
           + CAST(processing_days AS DOUBLE) / (SELECT CAST(max(processing_days) AS DOUBLE) FROM c) * 0.2,
           4) AS risk_score,
         CAST(p.risk_score AS DOUBLE) AS policy_risk_score, c.date_key AS date_id, fraud_flag,
         '2024-06-30' AS load_date
       FROM c LEFT JOIN policies p ON c.policy_id = p.policy_id""",
)
def batch_load(t: Tables):
    """The whole load from CSV files; the claims as the warehouse holds them."""
    folder = scratch_path(t.spark, "batch_load")
    write_source_files(t, f"{folder}/source")
    etl.run(t.spark, f"{folder}/source", f"{folder}/warehouse", datetime.date(2024, 6, 30))
    return t.spark.read.parquet(f"{folder}/warehouse/dwh_fact_claims").select(
        "claim_id", "payout_ratio", "rejected_amount", "risk_score", "policy_risk_score",
        "date_id", "fraud_flag", "load_date",
    )
