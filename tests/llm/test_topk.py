"""Exact top-k against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.llm import topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def answered(vectors, k=20, every=20):
    rows = topk.top_k(vectors, F.col("vec_id") % every == 0, k).collect()
    return sorted(tuple(r) for r in rows)


def expected(rows, k=20, every=20):
    sound = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in sound:
        if q is not None and q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i is not None, i) for i, b in sound if i != q]
            best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, _, i) in enumerate(best)]
    return sorted(out)


def clustered(count, dims=8, clusters=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims)) * 3
    return [(k, (centres[k % clusters] + rng.normal(size=dims) / 10).tolist()) for k in range(count)]


def test_clusters(spark):
    rows = clustered(600)
    assert answered(table(spark, rows)) == expected(rows)


def test_only_rows_in_reach_are_copied(spark, monkeypatch):
    """Several groups of queries: far clusters of the same norm are not copied to them."""
    rng = np.random.default_rng(3)
    centres = np.linalg.qr(rng.normal(size=(17, 17)))[0] * 4
    rows = [(k, (centres[k % 17] + rng.normal(size=17) / 50).tolist()) for k in range(1_700)]
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    written = {}
    keep = topk.materialize
    monkeypatch.setattr(topk, "materialize", lambda df, label: written.setdefault(label, keep(df, label)))
    assert answered(table(spark, rows)) == expected(rows)
    copies = written["wanted"].agg(F.sum(F.size("groups")), F.max(F.array_max("groups")), F.count("*")).first()
    assert copies[1] >= 10 and copies[0] < 2.5 * copies[2]


def test_many_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_QUERIES", 8)
    monkeypatch.setattr(topk, "SMALL_BLOCK", 40)
    monkeypatch.setattr(topk, "TILE", 500)
    monkeypatch.setattr(topk, "PIVOTS", 3)
    rows = clustered(500, clusters=2)
    assert answered(table(spark, rows), 7, 5) == expected(rows, 7, 5)


def test_ties_go_to_smaller_ids(spark):
    rows = [(k, [1.0, 0.0]) for k in range(100)] + [(100 + k, [0.5, float(k % 3)]) for k in range(50)]
    assert answered(table(spark, rows)) == expected(rows)


def test_a_hot_vector_is_limited_but_nothing_is_lost(spark):
    rows = [(k, [0.25, -0.5, 1.0]) for k in range(400)] + [(1_000 + k, [k / 100, 0.1, 0.3]) for k in range(100)]
    assert answered(table(spark, rows)) == expected(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0]),
        (7, [-3.0, 2.0, 9.0]), (20, []), (40, [0.0, 0.0]), (None, [1.0, 2.0]), (-20, [2.5, -1.0]), (60, None),
    ]
    vectors = table(spark, rows).selectExpr("*", "1 AS id", "2 AS row_no", "3 AS codes", "4 AS cell", "5 AS g")
    assert answered(vectors) == expected(rows)


def test_repeated_rows_answer_each_for_itself(spark):
    rows = [(0, [1.0]), (0, [1.0]), (3, [2.0]), (3, [2.0])]
    assert answered(table(spark, rows)) == [(0, 1, 3, 8192), (0, 1, 3, 8192), (0, 2, 3, 8192), (0, 2, 3, 8192)]


def test_no_rows_and_no_queries(spark):
    assert answered(table(spark, [])) == []
    assert answered(table(spark, [(1, [1.0])])) == []
    assert answered(table(spark, [(0, [1.0])])) == []


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=3) * 4e6).tolist()) for k in range(60)]
    assert answered(table(spark, rows)) == expected(rows)
    with pytest.raises(ValueError):
        topk.top_k(table(spark, [(0, [1e9])]), F.lit(True))
