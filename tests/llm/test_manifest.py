"""The Merkle manifest against trees built with the standard library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkclaims.llm import merkle, sha256
from sparkclaims.llm.words import ascii_lower


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climb(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def upwards(levels, at, value):
    siblings = []
    for nodes in levels[:-1]:
        run = at - at % 16
        rest = nodes[run : run + 16]
        siblings += rest[: at % 16] + rest[at % 16 + 1 :]
        value = digest(*rest[: at % 16], value, *rest[at % 16 + 1 :])
        at //= 16
    return value, siblings


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf(r, r["text"]) for r in rows if r["source"] == s]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    found = []
    for s in sources:
        for at, r in enumerate([r for r in rows if r["source"] == s]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            subroot, low = upwards(trees[s], at, leaf(r, lowered(r["text"]) if hit else r["text"]))
            folded, high = upwards(top, sources.index(s), subroot)
            root = top[-1][0]
            found.append((r["doc_id"], leaf(r, r["text"]), trees[s][-1][0], root, digest(*low, *high), folded, folded == root))
    return found


def audited(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.audit(docs, tampered, {"text": ascii_lower(F.col("text"))})


def same(docs):
    got = [tuple(r) for r in audited(docs).collect()]
    want = expected([r.asDict() for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("size", [16, 17, 257, 4_097])
def test_groups_around_the_sizes_of_runs_and_blocks(documents, size):
    rows = [(k * 3, f"Text {k}", "big") for k in range(size)] + [(1, "A lone Leaf", "small")]
    same(documents(*rows))


def test_many_groups_make_a_deep_upper_tree(documents):
    same(documents(*[(k, f"T{k}", f"source {k % 300}") for k in range(700)]))


def test_one_row_has_its_leaf_as_the_root(documents):
    row = audited(documents((5, "One"))).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == digest()


def test_edges(documents):
    rows = [
        (None, "No id", "a"), (None, None, None), (5, None, "a"), (5, "", "a"), (5, "Same", "b"), (5, "Same", "b"),
        (-7, "ÄÖ É x", "é"), (15, "Long " * 200_000, ""), (20, "tiny", "a"), (25, "no capitals", "A"),
    ]
    got = same(documents(*rows).selectExpr("*", "1 AS digest", "2 AS grp", "3 AS id", "4 AS pos", "5 AS changed"))
    assert len(got) == len(rows)


def test_no_rows(documents):
    assert audited(documents()).collect() == []


def test_a_tampered_row_is_found_and_no_other(documents):
    docs = documents(*[(k, f"Some Text {k}") for k in range(400)])
    for row in audited(docs).collect():
        assert row["verified"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 != 0)


def test_malformed_text(spark, documents):
    docs = documents((1, "x"), (5, "y")).withColumn("text", F.expr("CAST(X'41FF42' AS STRING)"))
    rows = audited(docs).collect()
    assert len(rows) == 2 and len({r["root"] for r in rows}) == 1


def test_hashes_resume_from_stored_states():
    values = [hashlib.sha256(bytes([k])).digest() for k in range(20)]
    words = sha256.words_of(b"".join(values))
    for whole in range(1, 20):
        state = sha256.first_states(1)
        for k in range(whole):
            stored = sha256.bytes_of(state)
            state = sha256.compress(sha256.words_of(stored), sha256.hex_blocks(words[k : k + 1]))
        state = sha256.compress(state, sha256.last_blocks(np.array([whole])))
        assert sha256.bytes_of(state).hex() == digest(*[v.hex() for v in values[:whole]])


def test_states_are_kept_before_each_child(documents):
    leaves = documents(*[(k, f"t{k}") for k in range(20)]).select(
        F.col("source").alias("grp"), F.col("doc_id").alias("id"), merkle.leaf_digest([F.col("text")]).alias("digest")
    )
    block = merkle.build(leaves).layers[0].first()
    states = sha256.words_of(bytes(block["states"]))
    # 20 children, and the two parents below the top.
    assert len(states) == 22 and (states[[0, 16, 20]] == sha256.first_states(3)).all()
