from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from sparkclaims.schemas import CLAIM_STREAM
from sparkclaims.streaming import claims as streams

HEADER = ",".join(CLAIM_STREAM.names)


def arrive(folder, name, *rows):
    """Write a file whose modification time follows the ones before it."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    stamp = time.time() - 1000 + 10 * len(list(folder.iterdir()))
    os.utime(path, (stamp, stamp))


def line(i, when, kind="Fire", score=0.5, flag="true"):
    return f"S{i},P{i},{when},{kind},100.0,{score},{flag},Pending"


@pytest.fixture
def work(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def test_alerts(spark, work, rows):
    folder, out, checkpoint = work
    arrive(folder, "1.csv", line(1, "2025-01-15", score=0.8), line(2, "2025-01-15", score=0.5),
           line(3, "2025-01-15", score=0.49), line(4, "2025-01-15", score=0.9, flag="false"))
    found = streams.alerts(streams.csv_stream(spark, str(folder)))
    streams.append_to_files(found, out, checkpoint).awaitTermination()
    got = rows(spark.read.parquet(out), "claim_id", "alert_level")
    assert [(i, level.split()[1]) for i, level in got] == [("S1", "CRITICAL"), ("S2", "HIGH"), ("S3", "NORMAL")]


def test_restart_reads_only_new_files(spark, work):
    folder, out, checkpoint = work
    for name, expected in [("1.csv", 1), ("2.csv", 2), (None, 2)]:
        if name:
            arrive(folder, name, line(expected, "2025-01-15"))
        query = streams.ingest_csv(spark, str(folder), CLAIM_STREAM, out, checkpoint)
        query.awaitTermination()
        assert spark.read.parquet(out).count() == expected
    status = streams.ingest_status(query)
    assert not status["active"] and status["rows_in_all"] == 0


def test_complete_totals(spark, work, rows):
    folder, out, checkpoint = work
    arrive(folder, "1.csv", line(1, "2025-01-15"), line(2, "2025-01-15", "Theft", 0.25, "false"))
    arrive(folder, "2.csv", line(3, "2025-01-16", score=0.75))
    stream = streams.csv_stream(spark, str(folder), files_per_batch=1)
    totals = streams.type_totals(stream)
    streams.complete_to_files(totals, out, checkpoint).awaitTermination()
    got = streams.latest_complete(spark, out, totals.schema)
    assert [(a, b, c, float(d)) for a, b, c, d in rows(got)] == [("Fire", 2, 2, 0.625), ("Theft", 1, 0, 0.25)]


def test_late_rows(spark, work, rows):
    """A late row of the second batch counts, one of the third is dropped: rows
    are held against the watermark of the batch before."""
    folder, out, checkpoint = work
    arrive(folder, "1.csv", line(1, "2025-01-20 00:00:00"))
    arrive(folder, "2.csv", line(2, "2025-01-10 00:00:00"), line(3, "2025-01-21 00:00:00"))
    arrive(folder, "3.csv", line(4, "2025-01-10 06:00:00"), line(5, "2025-01-22 00:00:00"))
    stream = streams.event_time(streams.csv_stream(spark, str(folder), files_per_batch=1))
    query = streams.append_to_files(streams.tumbling_totals(stream), out, checkpoint)
    query.awaitTermination()
    got = spark.read.parquet(out).select(F.col("window_start").cast("date").cast("string"), "claim_count")
    assert rows(got) == [("2025-01-10", 1), ("2025-01-20", 1)]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_console(spark, work):
    folder, _, checkpoint = work
    arrive(folder, "1.csv", line(1, "2025-01-15"))
    query = streams.show_batches(
        streams.type_totals(streams.csv_stream(spark, str(folder))), "complete", checkpoint
    )
    query.awaitTermination()
    assert streams.ingest_status(query)["rows_in_last_batch"] == 1


def test_event_time_of_bad_text(spark):
    df = spark.createDataFrame([("2025-01-15",), ("soon",), (None,)], "claim_date string")
    assert streams.event_time(df).filter("claim_date IS NULL").count() == 2
