"""Late rows, and summaries that a stream keeps up to date."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators import summary
from sparkclaims.schemas import CLAIM_STREAM
from sparkclaims.storage import written_versions
from sparkclaims.streaming import claims as streams
from sparkclaims.streaming.late import LateWindows, totals
from test_streaming import arrive, line

# Each file makes the windows before it late for the next ones.
FILES = [
    [line(1, "2025-01-20 00:00:00"), line(2, "2025-01-20 10:00:00", "Theft", 0.25, "false")],
    [line(3, "2025-01-10 00:00:00"), line(4, "2025-01-21 00:00:00"), line(5, "soon")],
    [line(6, "2025-01-10 06:00:00", score=0.75), line(7, "2025-01-22 00:05:00"), line(8, "")],
    [line(9, "2025-01-21 23:59:59"), line(10, "2025-01-20 01:00:00", "Theft"), line(11, "2025-01-22 01:00:00")],
]


@pytest.fixture
def arrived(tmp_path):
    for number, rows in enumerate(FILES):
        arrive(tmp_path / "in", f"{number}.csv", *rows)
    return tmp_path


def run(spark, work, files_per_batch, name="out"):
    windows = LateWindows(str(work / name))
    stream = streams.event_time(streams.csv_stream(spark, str(work / "in"), files_per_batch=files_per_batch))
    streams.each_batch(stream, windows.save(), str(work / f"{name}-checkpoint")).awaitTermination()
    return windows, stream.schema


def late_ids(windows, spark, schema):
    return {r["claim_id"]: r["batch"] for r in windows.late_rows(spark, schema).collect()}


def test_windows_and_late_rows_hold_every_row_once(spark, arrived, rows):
    results = []
    for files_per_batch in (1, 2, 1000):
        windows, schema = run(spark, arrived, files_per_batch, f"out{files_per_batch}")
        late = late_ids(windows, spark, schema)
        counted = sum(
            windows.windows(spark, schema, closed).agg(F.coalesce(F.sum("claim_count"), F.lit(0))).first()[0]
            for closed in (True, False)
        )
        assert counted + len(late) == 11 and {"S5", "S8"} <= set(late)
        results.append(rows(totals(windows.corrected(spark, schema)).select(F.col("window_start").cast("string"), "claim_type", "claim_count", "fraud_count")))
        if files_per_batch == 1:
            # 21 January ends at 22 January 00:00; the mark before the last file is 21 January 23:55.
            assert late == {"S3": 1, "S5": 1, "S6": 2, "S8": 2, "S10": 3}
        if files_per_batch == 1000:
            assert set(late) == {"S5", "S8"}
    assert results[0] == results[1] == results[2]
    assert ("2025-01-10 00:00:00", "Fire", 2, 2) in results[0]


def test_a_window_is_final_when_the_watermark_passes_its_end(spark, arrived, rows):
    windows, schema = run(spark, arrived, 1)
    day = F.col("window_start").cast("date").cast("string")
    assert rows(windows.windows(spark, schema), day, "claim_type", "claim_count") == [
        ("2025-01-20", "Fire", 1), ("2025-01-20", "Theft", 1), ("2025-01-21", "Fire", 2),
    ]
    assert rows(windows.windows(spark, schema, closed=False), day, "claim_count") == [("2025-01-22", 2)]
    met = windows.late_rows(spark, schema).select("claim_id", F.col("watermark").cast("string"))
    assert ("S10", "2025-01-21 23:55:00") in rows(met)


def test_a_batch_that_runs_twice_changes_nothing(spark, arrived, rows):
    windows, schema = run(spark, arrived, 1)
    before = rows(windows.corrected(spark, schema)), late_ids(windows, spark, schema)
    last = streams.event_time(spark.read.schema(CLAIM_STREAM).csv(str(arrived / "in/3.csv"), header=True))
    windows.save()(last, 3)
    assert (rows(windows.corrected(spark, schema)), late_ids(windows, spark, schema)) == before


def test_a_restart_goes_on_from_the_written_state(spark, tmp_path, rows):
    for number, content in enumerate(FILES):
        arrive(tmp_path / "in", f"{number}.csv", *content)
        windows, schema = run(spark, tmp_path, 1)
    assert set(late_ids(windows, spark, schema)) == {"S3", "S5", "S6", "S8", "S10"}
    assert windows.corrected(spark, schema).agg(F.sum("claim_count")).first()[0] == 9


def test_batches_without_rows_and_without_times(spark, tmp_path):
    arrive(tmp_path / "in", "1.csv", line(1, "never"))
    windows, schema = run(spark, tmp_path, 1)
    assert windows.windows(spark, schema).count() == 0 and late_ids(windows, spark, schema) == {"S1": 0}
    windows.save()(spark.createDataFrame([], schema), 1)
    assert windows.corrected(spark, schema).count() == 0
    assert written_versions(spark, f"{windows.base}/state") == [0, 1]


KEYS, SUMS = ["k"], ["n", "total"]


def delta(spark, *values):
    rows = spark.createDataFrame(values, "k string, n long, total long")
    return rows.withColumn("total", F.col("total").cast("decimal(10,2)"))


def test_a_summary_takes_each_batch_once(spark, tmp_path, rows):
    base = str(tmp_path / "summary")
    first, second = delta(spark, ("a", 1, 1), (None, 2, 2)), delta(spark, ("a", 3, None), ("b", 1, 5))
    summary.refresh_batch(spark, base, 0, first, KEYS, SUMS)
    summary.refresh_batch(spark, base, 1, second, KEYS, SUMS)
    once = rows(summary.latest_summary(spark, base))
    assert [r[:2] for r in once] == [(None, 2), ("a", 4), ("b", 1)]
    for batch, part in ((1, second), (1, second)):
        summary.refresh_batch(spark, base, batch, part, KEYS, SUMS)
    assert rows(summary.latest_summary(spark, base)) == once
    summary.refresh_batch(spark, base, 2, delta(spark, ("b", 1, 1)), KEYS, SUMS)
    assert written_versions(spark, base) == [1, 2]


def test_a_half_written_summary_is_not_read(spark, tmp_path, rows):
    base = tmp_path / "summary"
    summary.refresh_batch(spark, str(base), 0, delta(spark, ("a", 1, 1)), KEYS, SUMS)
    (base / "version=1").mkdir()
    (base / "version=1" / "part-0.parquet").write_bytes(b"half")
    assert rows(summary.latest_summary(spark, str(base)), "k", "n") == [("a", 1)]
    summary.refresh_batch(spark, str(base), 1, delta(spark, ("a", 1, 1)), KEYS, SUMS)
    assert rows(summary.latest_summary(spark, str(base)), "k", "n") == [("a", 2)]


def test_a_summary_with_a_repeated_key_stops(spark, tmp_path):
    with pytest.raises(Exception, match="duplicate key"):
        summary.refresh_batch(spark, str(tmp_path / "s"), 0, delta(spark, ("a", 1, 1), ("a", 2, 2)), KEYS, SUMS)
    with pytest.raises(FileNotFoundError):
        summary.latest_summary(spark, str(tmp_path / "s"))


def test_a_stream_of_batches_makes_the_whole_summary(spark, tmp_path, rows):
    for number in range(4):
        arrive(tmp_path / "in", f"{number}.csv", line(number, "2025-01-15"), line(9, "2025-01-15", "Theft", 0.25))

    def summarise(facts):
        return facts.groupBy(F.col("claim_type").alias("k")).agg(F.count("*").alias("n"), F.sum(F.col("fraud_score").cast("decimal(10,2)")).cast("decimal(10,2)").alias("total"))

    base = str(tmp_path / "summary")
    stream = streams.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    streams.each_batch(stream, summary.apply_batches(summarise, base, KEYS, SUMS), str(tmp_path / "c")).awaitTermination()
    got = [(k, n, float(total)) for k, n, total in rows(summary.latest_summary(spark, base))]
    assert got == [("Fire", 4, 2.0), ("Theft", 4, 1.0)]
