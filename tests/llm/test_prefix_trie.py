"""The prefix trie against rebuilt sequences held in Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.llm import prefix_trie

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def ref(turn):
    return hashlib.sha256(f"{len(turn[0].encode())}:{turn[0]}{turn[1]}".encode()).hexdigest()


def head_size(conv):
    return zlib.crc32(str(conv).encode()) % 4


def base(conv):
    return conv - (conv % 20 if conv >= 0 else -(-conv % 20))


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, ref((role or "", text or "")), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {c: own.get(base(c), [])[: head_size(c)] + ts[head_size(c) :] for c, ts in own.items()}
    members = defaultdict(list)
    for c, ts in sorted(whole.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = ",".join(str(c) for c in convs if len(whole[c]) == len(path))
        out.append(
            (
                convs[0], len(path), members[path[:-1]][0] if path else None, len(convs),
                sum(len(p) == len(path) + 1 for p in below),
                sum(all(len(whole[c]) == len(p) for c in members[p]) for p in below),
                sum((len(members[p]) - 1) * words(p) for p in below), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: r[:2])


def built(spark, rows, seed=0):
    conv = F.col("conv_id")
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rep", "2 AS depth", "'x' AS ref", "3 AS words")
    found = prefix_trie.trie(table, F.crc32(conv.cast("string")) % 4, conv - conv % 20, seed)
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])


def made(count, seed, choices=3, longest=6):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), f"turn {rng.randrange(choices)}" + " word" * rng.randrange(3))
        for c in range(count)
        for t in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = made(70, seed)
    assert built(spark, rows) == expected(rows)


def test_copies_and_a_hot_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(c, 0, "user", "same 0") for c in range(100, 130)] + [(c, 1, "bot", f"own {c}") for c in range(100, 130)]
    assert built(spark, rows) == expected(rows)


def test_a_long_conversation_goes_over_blocks(spark, monkeypatch, many_blocks):
    cut = prefix_trie.ordered_blocks
    monkeypatch.setattr(prefix_trie, "ordered_blocks", lambda df, order: cut(df, order, block_rows=7, partition_rows=40))
    rows = [(c, t, "user", f"t {t % 5}") for c in (3, 23, 40) for t in range(60)] + [(23, 60, "user", "last")] + made(20, 4)
    rows = [r for r in rows if r[0] not in (3,) or r[1] >= 6 or r[3].startswith("t ")]
    assert built(spark, rows) == expected(rows)


def test_edges(spark):
    rows = [
        (0, 1, None, None), (0, None, "user", "first"), (0, 2, "user", ""), (7, 5, "user", "x " * 100_000),
        (None, 1, "user", "nobody's"), (-3, 1, "user", "negative"), (-20, 1, "bot", "é ü"), (20, 0, "user", "only"),
        (41, 0, "user", "twice"), (41, 0, "user", "twice"), (45, 1, "a", "tie"), (45, 1, "b", "tie"),
        (61, None, None, None), (4_095, 0, "user", "run"), (4_096, 0, "user", "run"), (100_000, 0, "user", "run"),
    ]
    assert built(spark, rows) == expected(rows)


def test_no_conversations(spark):
    assert built(spark, []) == []
    assert built(spark, [(None, 0, "user", "x")]) == []


def test_another_base_is_drawn_after_a_collision(spark, monkeypatch):
    """A group whose references differ is never returned: the next base gives the same trie."""
    groups, tried = prefix_trie._groups, []

    def first_fails(rows):
        tried.append(rows)
        return groups(rows).withColumn("sound", F.lit(len(tried) > 1))

    monkeypatch.setattr(prefix_trie, "_groups", first_fails)
    rows = made(12, 9, longest=4)
    assert built(spark, rows) == expected(rows)
    assert len(tried) == 2 and prefix_trie._base(0, 0) != prefix_trie._base(0, 1)


def test_groups_with_unlike_references_are_told(spark):
    rows = spark.range(2).selectExpr(
        "id AS conv_id", "1L AS depth", "1L AS length", "encode(CAST(id AS STRING), 'UTF-8') AS ref", "5L AS f0", "6L AS f1", "7L AS f2"
    )
    assert [r["sound"] for r in prefix_trie._groups(rows).collect()] == [False]
