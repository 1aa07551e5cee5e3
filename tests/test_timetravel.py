"""Tables read as of a version, from bases and the tail after them."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sparkclaims.operators.timetravel import VersionedTable
from sparkclaims.schemas import INT, STRING, table

SCHEMA = table(k=STRING, region=STRING, v=INT)
START = datetime.datetime(2025, 1, 1)


def hour(n):
    return START + datetime.timedelta(hours=n)


@pytest.fixture
def users(tmp_path):
    return VersionedTable(str(tmp_path / "users"), SCHEMA, ("k", "region"))


def commit(spark, users, n, *rows):
    changes = spark.createDataFrame(rows, "k string, region string, v int, deleted boolean")
    return users.commit(changes, hour(n), f"q{n}")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def filled(spark, users):
    """Ten commits, bases after 3 and 6, and what each version holds."""
    rng, state, states = random.Random(1), {}, []
    for n in range(10):
        named = {(rng.choice("abcdef"), rng.choice(["x", None])) for _ in range(4)}
        rows = [(k, region, rng.choice([n, None]), rng.random() < 0.25) for k, region in sorted(named, key=repr)]
        assert commit(spark, users, n, *rows) == n
        for k, region, v, gone in rows:
            state.pop((k, region), None) if gone else state.update({(k, region): (k, region, v)})
        states.append(sorted(state.values(), key=repr))
        if n in (3, 6):
            users.checkpoint(spark)
    return states


def test_every_version_reads_as_it_was(spark, users, filled):
    for version, rows in enumerate(filled):
        assert got(users.read(spark, version)) == rows
    assert got(users.read(spark)) == filled[-1]


def test_a_read_lists_no_file_before_its_base(spark, users, filled):
    def folders(version):
        return {f.split("/users/")[1].rsplit("/", 1)[0] for f in users.read(spark, version).inputFiles()}

    assert folders(5) == {"bases/version=3", "changes/version=4", "changes/version=5"}
    assert folders(6) == {"bases/version=6"}
    assert folders(2) == {f"changes/version={v}" for v in (0, 1, 2)}


def test_times_and_statements_name_versions(spark, users, filled):
    assert users.version_at(spark, hour(4) + datetime.timedelta(minutes=59)) == 4 and users.version_at(spark, hour(4)) == 4
    assert users.version_before(spark, "q7") == 6
    for wrong in (lambda: users.version_at(spark, hour(-1)), lambda: users.version_before(spark, "q0"), lambda: users.version_before(spark, "none"),
                  lambda: users.read(spark, 10), lambda: users.read(spark, -1)):
        with pytest.raises(LookupError):
            wrong()


def test_restore_keeps_what_lies_between(spark, users, filled):
    assert users.restore(spark, 2, hour(20), "undo") == 10
    assert got(users.read(spark)) == filled[2] and got(users.read(spark, 9)) == filled[9]
    commit(spark, users, 21, ("new", "x", 1, False))
    assert got(users.read(spark)) == sorted([*filled[2], ("new", "x", 1)], key=repr)
    assert got(users.read(spark, users.version_before(spark, "undo"))) == filled[9]


def test_a_clone_shares_rows_until_either_changes(spark, users, filled, tmp_path):
    copy = users.clone(spark, str(tmp_path / "copy"), hour(30), 5)
    assert got(copy.read(spark)) == filled[5]
    assert not (tmp_path / "copy" / "bases").exists() and not (tmp_path / "copy" / "changes").exists()
    commit(spark, copy, 31, ("c", "x", 99, False))
    commit(spark, users, 31, ("d", "x", 98, False))
    assert ("c", "x", 99) in got(copy.read(spark)) and ("d", "x", 98) not in got(copy.read(spark))
    assert ("c", "x", 99) not in got(users.read(spark)) and got(copy.read(spark, 0)) == filled[5]
    with pytest.raises(ValueError):
        users.clone(spark, str(tmp_path / "copy"), hour(32))


def test_forgotten_versions_cannot_be_read(spark, users, filled):
    assert users.forget(spark, 7) == [0, 1, 2, 3, 4, 5, 6]
    assert got(users.read(spark, 8)) == filled[8] and got(users.read(spark, 6)) == filled[6]
    with pytest.raises(LookupError):
        users.read(spark, 4)


def test_a_commit_that_died_is_written_again(spark, users, monkeypatch):
    commit(spark, users, 0, ("a", "x", 1, False))
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_enter", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commit(spark, users, 1, ("lost", "x", 1, False))
    assert got(users.read(spark)) == [("a", "x", 1)]
    assert commit(spark, users, 1, ("b", "x", 2, False)) == 1
    assert got(users.read(spark)) == [("a", "x", 1), ("b", "x", 2)]


def test_wrong_commits(spark, users):
    with pytest.raises(LookupError):
        users.read(spark)
    commit(spark, users, 5, ("a", None, 1, None))
    with pytest.raises(ValueError):
        commit(spark, users, 4, ("a", "x", 1, False))
    with pytest.raises(Exception, match="duplicate key"):
        commit(spark, users, 6, ("a", "x", 1, False), ("a", "x", 2, False))
    assert got(users.read(spark)) == [("a", None, 1)]
    assert users.commit(users.read(spark).limit(0), hour(7)) == 1 and got(users.read(spark)) == [("a", None, 1)]
    kinds = users.manifest(spark).select("version", "statement", "kind").orderBy("version")
    assert [tuple(r) for r in kinds.collect()] == [(0, "q5", "changes"), (1, None, "changes")]
    assert users.changes(spark, -1, 1).agg(F.count("*")).first()[0] == 1
