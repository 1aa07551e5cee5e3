"""Streaming queries over the events, run to the end of the available files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.bindings.analysis import SUMMARY, exact
from sparkclaims.bindings.registry import query
from sparkclaims.bindings.tables import Tables
from sparkclaims.schemas import BOOLEAN, DOUBLE, STRING, table
from sparkclaims.sources.writers import write_csv
from sparkclaims.operators.summary import apply_batches, latest_summary
from sparkclaims.plans import reports
from sparkclaims.plans.star import ClaimStar
from sparkclaims.storage import local_table, scratch_path
from sparkclaims.streaming import claims as streams
from sparkclaims.streaming.late import LateWindows, totals

TOTALS = f"""COUNT(*) AS claim_count, CAST(SUM(fraud) AS BIGINT) AS fraud_count,
    {exact('SUM(fraud_score)', 'COUNT(*)', 4, 4)} AS avg_fraud_score"""


def _stream(t: Tables):
    events = streams.parquet_stream(t.spark, t.folder, t.event_schema, "events.parquet")
    return t.stream_claims(events)


@query(
    "stream_alerts",
    """SELECT claim_id, claim_type, claimed_amount, CAST(fraud_score AS DOUBLE) AS fraud_score,
         CASE WHEN fraud_score >= 0.8 THEN '\U0001F534 CRITICAL' WHEN fraud_score >= 0.5 THEN '\U0001F7E1 HIGH'
           ELSE '\U0001F7E2 NORMAL' END AS alert_level, status
       FROM stream_claims WHERE fraud_flag""",
)
def stream_alerts(t: Tables):
    path = scratch_path(t.spark, "stream_alerts")
    found = streams.alerts(_stream(t))
    streams.append_to_files(found, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return t.spark.read.schema(found.schema).parquet(f"{path}/data")


@query("stream_type_totals", f"SELECT claim_type, {TOTALS} FROM stream_claims GROUP BY claim_type")
def stream_type_totals(t: Tables):
    path = scratch_path(t.spark, "stream_type_totals")
    totals = streams.type_totals(_stream(t))
    streams.complete_to_files(totals, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return streams.latest_complete(t.spark, f"{path}/data", totals.schema)


@query(
    "stream_tumbling",
    f"""SELECT CAST(time_bucket(INTERVAL 1 DAY, claim_date) AS VARCHAR) AS window_start,
         CAST(time_bucket(INTERVAL 1 DAY, claim_date) + INTERVAL 1 DAY AS VARCHAR) AS window_end,
         claim_type, {TOTALS}
       FROM stream_claims
       WHERE time_bucket(INTERVAL 1 DAY, claim_date) + INTERVAL 1 DAY
         <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
       GROUP BY 1, 2, 3""",
)
def stream_tumbling(t: Tables):
    """Windows that the watermark has closed; the last day stays open."""
    path = scratch_path(t.spark, "stream_tumbling")
    totals = streams.tumbling_totals(_stream(t))
    streams.append_to_files(totals, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return t.spark.read.schema(totals.schema).parquet(f"{path}/data")


INGEST_ROWS = table(
    claim_id=STRING, claim_date=STRING, claim_type=STRING, claimed_amount=DOUBLE, fraud_flag=BOOLEAN
)


@query(
    "stream_ingest",
    """SELECT CAST(claim_id AS VARCHAR) AS claim_id, claim_type, claimed_amount, fraud_flag FROM stream_claims""",
)
def stream_ingest(t: Tables):
    """CSV files that arrive in two parts; the second run adds only the new ones."""
    path = scratch_path(t.spark, "stream_ingest")
    rows = t.stream_claims(t.raw("events")).select(
        F.col("claim_id").cast("string").alias("claim_id"),
        F.col("claim_date").cast("string").alias("claim_date"),
        "claim_type", "claimed_amount", "fraud_flag",
    )
    for part, condition in [(1, "claim_date < '2024-01-16'"), (2, "claim_date >= '2024-01-16' OR claim_date IS NULL")]:
        write_csv(rows.filter(condition), f"{path}/files/{part}")
        streams.ingest_csv(
            t.spark, f"{path}/files/*", INGEST_ROWS, f"{path}/data", f"{path}/checkpoint"
        ).awaitTermination()
    return t.spark.read.schema(INGEST_ROWS).parquet(f"{path}/data").drop("claim_date")


def _arrivals(t: Tables, rows: DataFrame, path: str, parts: list[str], run: Callable[[DataFrame], object]) -> None:
    """Files that arrive part by part, with a run of the stream (to its end) after each."""
    for number, condition in enumerate(parts):
        rows.filter(condition).write.parquet(f"{path}/files/{number}")
        stream = t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{path}/files/*")
        run(stream).awaitTermination()


# Every fifth event comes with the next part; those of odd users in a last one.
_PARTS = [
    "claim_id % 5 <> 0 AND claim_date < '2024-01-12'",
    "(claim_id % 5 = 0 AND claim_date < '2024-01-12') OR (claim_id % 5 <> 0 AND claim_date >= '2024-01-12' AND policy_id % 2 = 0)",
    "(claim_id % 5 = 0 AND claim_date >= '2024-01-12') OR (claim_id % 5 <> 0 AND claim_date >= '2024-01-12' AND policy_id % 2 <> 0)",
]
_PART_SQL = f"""(SELECT *, CASE WHEN {_PARTS[0]} THEN 0 WHEN {_PARTS[1]} THEN 1 ELSE 2 END AS part FROM stream_claims)"""


def _late_windows(t: Tables, name: str):
    path = scratch_path(t.spark, name)
    rows = t.stream_claims(t.raw("events"))
    windows = LateWindows(f"{path}/windows")
    _arrivals(t, rows, path, _PARTS, lambda stream: streams.each_batch(stream, windows.save(), f"{path}/checkpoint"))
    return windows, rows.schema


@query(
    "stream_late_rows",
    f"""WITH p AS {_PART_SQL},
         m AS (SELECT part + 1 AS part, max(max(claim_date)) OVER (ORDER BY part) - INTERVAL 10 MINUTE AS mark FROM p GROUP BY part)
       SELECT claim_id, claim_type, CAST(claim_date AS VARCHAR) AS claim_date, CAST(p.part AS BIGINT) AS batch,
         CAST(mark AS VARCHAR) AS watermark
       FROM p JOIN m ON p.part = m.part WHERE time_bucket(INTERVAL 1 DAY, claim_date) + INTERVAL 1 DAY <= mark""",
)
def stream_late_rows(t: Tables):
    """The rows whose window was closed when they came, by the batch that brought them."""
    windows, schema = _late_windows(t, "stream_late_rows")
    return windows.late_rows(t.spark, schema).select("claim_id", "claim_type", "claim_date", "batch", "watermark")


@query(
    "stream_corrected",
    f"""SELECT CAST(time_bucket(INTERVAL 1 DAY, claim_date) AS VARCHAR) AS window_start,
         CAST(time_bucket(INTERVAL 1 DAY, claim_date) + INTERVAL 1 DAY AS VARCHAR) AS window_end, claim_type, {TOTALS}
       FROM stream_claims GROUP BY 1, 2, 3""",
)
def stream_corrected(t: Tables):
    """Windows in time and late rows together: every row counts."""
    windows, schema = _late_windows(t, "stream_corrected")
    return totals(windows.corrected(t.spark, schema))


@query("mv_stream", SUMMARY)
def mv_stream(t: Tables):
    """The summary of claims kept up to date by a stream in three parts, the last batch run once more."""
    path, star = scratch_path(t.spark, "mv_stream"), t.star

    def summarise(claims: DataFrame) -> DataFrame:
        return reports.summary_sums(
            ClaimStar(claims, star.policies, star.customers, star.policy_types, star.agents, star.dates)
        )

    save = apply_batches(summarise, f"{path}/summary")
    parts = ["date_key < 19970101", "date_key >= 19970101 AND date_key < 19990101", "date_key >= 19990101"]
    _arrivals(t, star.claims, path, parts, lambda stream: streams.each_batch(stream, save, f"{path}/checkpoint"))
    save(star.claims.filter(parts[-1]), len(parts) - 1)
    return reports.claim_summary(latest_summary(t.spark, f"{path}/summary"))


@query(
    "stream_status",
    """SELECT part + 1 AS run, false AS active, COUNT(*) AS rows_in_all, (SELECT COUNT(*) FROM stream_claims s
         WHERE (claim_date >= TIMESTAMP '2024-01-16') <= (part = 1)) AS rows_loaded
       FROM (SELECT CAST(claim_date >= TIMESTAMP '2024-01-16' AS BIGINT) AS part FROM stream_claims) GROUP BY part""",
)
def stream_status(t: Tables):
    """What two runs of an ingest say of themselves, and the rows that are there after each."""
    path = scratch_path(t.spark, "stream_status")
    rows = t.stream_claims(t.raw("events")).select(
        F.col("claim_id").cast("string").alias("claim_id"), F.col("claim_date").cast("string").alias("claim_date"),
        "claim_type", "claimed_amount", "fraud_flag",
    )
    seen: dict[str, list] = {"run": [], "active": [], "rows_in_all": [], "rows_loaded": []}
    for run, condition in [(1, "claim_date < '2024-01-16'"), (2, "claim_date >= '2024-01-16'")]:
        write_csv(rows.filter(condition), f"{path}/files/{run}")
        ingest = streams.ingest_csv(t.spark, f"{path}/files/*", INGEST_ROWS, f"{path}/data", f"{path}/checkpoint")
        ingest.awaitTermination()
        status = streams.ingest_status(ingest)
        loaded = t.spark.read.schema(INGEST_ROWS).parquet(f"{path}/data").count()
        for name, value in zip(seen, (run, status["active"], status["rows_in_all"], loaded), strict=True):
            seen[name].append(value)
    return local_table(t.spark, seen, "run long, active boolean, rows_in_all long, rows_loaded long")
