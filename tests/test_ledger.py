"""Bulk loads take each file once."""

from __future__ import annotations

import os

import pytest

from sparkclaims.schemas import DATE, INT, MONEY, STRING, table
from sparkclaims.sources.ledger import CONTINUE, SKIP_FILE, LoadLedger
from sparkclaims.storage import written_versions

SCHEMA = table(claim_id=STRING, claim_date=DATE, amount=MONEY, days=INT)
HEADER = ",".join(SCHEMA.names)


def put(folder, name, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "in"
    put(folder, "one.csv", "c1,2024-01-01,5.00,3", "c2,2024-01-02,NULL,4")
    put(folder, "sub/with space.csv", "c3,2024-01-03,1.00,soon", 'c4,2024-01-04,2.00,1')
    put(folder, "bad.csv", "c5,never,1.00,1")
    put(folder, "empty.csv")
    (folder / "notes.txt").write_text("not a load file")
    return folder


@pytest.fixture
def ledger(tmp_path):
    return LoadLedger(str(tmp_path / "target"), SCHEMA)


def entered(spark, ledger):
    return {(os.path.basename(r["file"]).replace("%20", " "), r["load"]): (r["status"], r["rows_loaded"], r["rows_rejected"]) for r in ledger.entries(spark).collect()}


FIRST = {
    ("one.csv", 0): ("loaded", 2, 0), ("with space.csv", 0): ("partly loaded", 1, 1),
    ("bad.csv", 0): ("failed", 0, 1), ("empty.csv", 0): ("loaded", 0, 0),
}


def test_a_second_run_loads_nothing_and_a_new_file_only_its_rows(spark, drop, ledger, rows):
    assert ledger.load(spark, str(drop)) == [0] and entered(spark, ledger) == FIRST
    assert ledger.load(spark, str(drop)) == []
    assert rows(ledger.rows(spark), "claim_id", "load") == [("c1", 0), ("c2", 0), ("c4", 0)]
    put(drop, "two.csv", "c6,2024-01-06,1.00,1")
    assert ledger.load(spark, str(drop)) == [1]
    assert rows(ledger.rows(spark), "claim_id", "load")[3:] == [("c6", 1)]
    assert entered(spark, ledger) == {**FIRST, ("two.csv", 1): ("loaded", 1, 0)}
    faults = {r["claim_id"]: (r["bad_columns"], os.path.basename(r["file"])) for r in ledger.rejected(spark).collect()}
    assert faults == {"c3": (["days"], "with%20space.csv"), "c5": (["claim_date"], "bad.csv")}


def test_a_changed_file_is_new(spark, drop, ledger, rows):
    ledger.load(spark, str(drop))
    put(drop, "bad.csv", "c5,2024-01-05,1.00,1", "c7,2024-01-07,1.00,1")
    assert ledger.load(spark, str(drop)) == [1]
    assert rows(ledger.rows(spark), "claim_id", "load")[-2:] == [("c5", 1), ("c7", 1)]


def test_a_file_with_rejected_rows_can_be_skipped(spark, drop, ledger, rows):
    ledger.load(spark, str(drop), on_error=SKIP_FILE)
    assert rows(ledger.rows(spark), "claim_id") == [("c1",), ("c2",)]
    assert entered(spark, ledger)["with space.csv", 0] == ("failed", 0, 1)
    with pytest.raises(ValueError):
        ledger.load(spark, str(drop), on_error="abort")


def test_many_files_go_in_several_loads(spark, drop, ledger, rows):
    assert ledger.load(spark, str(drop), files_per_load=2) == [0, 1]
    assert {name for name, _ in entered(spark, ledger)} == {name for name, _ in FIRST}
    assert rows(ledger.rows(spark), "claim_id") == [("c1",), ("c2",), ("c4",)]


def test_a_load_that_died_has_not_happened(spark, drop, ledger, rows, monkeypatch):
    """Rows were written, the entries were not: they are not read, and the next load takes their place."""
    ledger.load(spark, str(drop), "one.csv")
    kept = LoadLedger.loads
    monkeypatch.setattr(LoadLedger, "loads", lambda self, spark: [0])
    ledger.load(spark, str(drop), "sub.csv", CONTINUE)
    dead = drop.parent / "target" / "rows" / "load=1"
    spark.createDataFrame([("lost", None, None, None, "f")], ledger.rows(spark).drop("load").schema.add("file", STRING)).write.parquet(str(dead))
    monkeypatch.setattr(LoadLedger, "loads", kept)
    assert rows(ledger.rows(spark), "claim_id") == [("c1",), ("c2",)]
    assert ledger.load(spark, str(drop)) == [1]
    assert rows(ledger.rows(spark), "claim_id") == [("c1",), ("c2",), ("c4",)]


def test_a_ledger_of_nothing(spark, ledger, tmp_path):
    assert ledger.rows(spark).count() == 0 and ledger.entries(spark).count() == 0 and ledger.rejected(spark).count() == 0
    (tmp_path / "nothing").mkdir()
    assert ledger.load(spark, str(tmp_path / "nothing")) == [] and written_versions(spark, f"{ledger.base}/ledger", "load") == []
