"""Operators beyond SQL, against brute force, round trips and held-out rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkclaims.llm import components, hashing, near_dedup, packing, ppm, toxicity
from sparkclaims.llm.queries import QUERIES

from conftest_llm import fold, linked_groups, shingle_sets, split


def test_hashes_of_words_and_shingles():
    texts = [b"One  two\tTHREE", b"", b" \n", "é two".encode(), b"one two three four five six", b"one"]
    words = hashing.words_of(texts)
    assert np.diff(words.starts).tolist() == [3, 0, 0, 2, 6, 1]
    h = words.hashes
    assert h[0] == h[5] == h[11] and h[1] == h[4] == h[6] and h[2] == h[7]
    assert len(set(h.tolist())) == 7
    shingles, starts = hashing.shingles_of(words, 3)
    assert np.diff(starts).tolist() == [1, 0, 0, 1, 4, 1] and shingles[0] == shingles[2]


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 300), (7, 7)] + [(1000, 1001 + k) for k in range(50)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and {got[100], got[200], got[300]} == {100}
    assert {got[1000 + k] for k in range(51)} == {1000}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return " ".join(out)


def test_near_copies_against_brute_force(documents):
    """A large group whose pairs lie on both sides of the bound, over several tiles."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, edited(rng, base, rng.randrange(0, 8))) for k in range(150)]
    for g in range(20):
        own = [f"g{g}w{k}" for k in range(rng.randrange(5, 300))]
        rows += [(1000 + 10 * g + k, edited(rng, own, k)) for k in range(3)]
    rows += [(5000, None), (5001, ""), (5002, "few words"), (5003, "FEW  words"), (5004, "few words here"), (5005, " \n")]
    rows += [(6000, " ".join(f"long{k}" for k in range(20_000))), (6001, " ".join(f"long{k}" for k in range(20_050)))]
    expected = linked_groups(shingle_sets(dict(rows)))
    got = {r["doc_id"]: r for r in near_dedup.near_groups(documents(*rows), tile=32).collect()}
    assert len(got) == len(rows)
    assert {k: r["component_id"] for k, r in got.items()} == expected
    assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(s) for k, s in shingle_sets(dict(rows)).items()}
    assert all(r["kept"] == (r["component_id"] == k) for k, r in got.items())


def test_near_copies_edges(documents):
    assert near_dedup.near_groups(documents()).collect() == []
    rows = [(None, "a b c d e f"), (3, "A b c d e f"), (3, "a b c d e f"), (None, None)]
    docs = documents(*rows)
    got = sorted(map(str, near_dedup.near_groups(docs).select("doc_id", "component_id", "kept").collect()))
    assert got == sorted(
        ["Row(doc_id=None, component_id=3, kept=False)", "Row(doc_id=3, component_id=3, kept=True)"]
        + ["Row(doc_id=3, component_id=3, kept=True)", "Row(doc_id=None, component_id=None, kept=True)"]
    )
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns


def test_one_row_of_each_group_stays(spark, documents):
    """Repeated rows, null ids, texts without words, and columns named as those used inside."""
    words = [f"w{k}" for k in range(60)]
    near = " ".join([*words[:59], "other"])
    rows = [(3, " ".join(words)), (3, " ".join(words)), (None, near), (7, near), (None, "a b c"), (None, "a b c"),
            (None, "A b c"), (None, "d e f"), (4, "x y z"), (4, "k l m"), (5, None), (5, None), (6, " \n"), (None, "")]
    docs = documents(*rows)
    for name in ("node", "digest", "component", "row", "text_key", "kept_id", "again.key"):
        docs = docs.withColumn(name, F.lit(name))
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=str)
    least = [(3, " ".join(words)), (None, "a b c"), (None, "d e f"), (4, "x y z"), (4, "k l m"), (5, ""), (5, ""), (6, " \n"), (None, "")]
    assert got == sorted(least, key=str)
    assert near_dedup.drop_near_copies(documents()).collect() == []


def test_many_null_ids_and_repeated_rows_meet_only_their_own_text(documents):
    words = [f"w{k}" for k in range(100)]
    rows = [(None, " ".join([*words[:k], "x", *words[k + 1:]])) for k in range(100)]
    rows += [(9, " ".join(words))] * 50
    docs = documents(*rows)
    got = near_dedup.near_groups(docs, tile=16).collect()
    assert len(got) == 150 and {r["component_id"] for r in got} == {9}
    sets = near_dedup._with_sets(
        docs.coalesce(1),
        docs.sparkSession.createDataFrame([(b"", 9, 0, 0, 0)], "digest binary, some_id long, some_key long, node long, cluster long"),
        "doc_id", "text", 5,
    )
    assert sets.count() == 0


def test_the_stage_drops_copies_from_80_percent_on(spark, documents):
    """Pairs with one changed word: 5 of n + 1 shingles differ, so n = 45 to 60 are between 0.80 and 0.85."""
    import corpus_pipeline

    rows = []
    for k, n in enumerate([*range(50, 60)] * 3):
        words = [f"d{k}w{j}" for j in range(n)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:20], "changed", *words[21:]]))]
    for k in (1000, 1002):
        words = [f"d{k}w{j}" for j in range(44)]
        rows += [(k, " ".join(words)), (k + 1, " ".join([*words[:20], "changed", *words[21:]]))]
    sets = shingle_sets(dict(rows))
    like = [len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 60, 2)]
    assert all(0.8 <= s < 0.85 for s in like)
    kept = corpus_pipeline.drop_near_copies(spark, documents(*rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [*range(0, 60, 2), 1000, 1001, 1002, 1003]


def test_near_dedup_query_against_brute_force(spark, folder, texts):
    expected = linked_groups(shingle_sets({k: r["text"] for k, r in texts.items()}))
    got = {r["doc_id"]: r["component_id"] for r in QUERIES["op8_near_dedup"](spark, folder).collect()}
    assert got == expected


# --- packing --------------------------------------------------------------------


def whole_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def packed_right(rows, texts, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append(row)
    assert set(by_doc) == set(texts)
    for key, parts in by_doc.items():
        ids, at = whole_ids(texts[key]), 0
        for row in sorted(parts, key=lambda r: r["start"]):
            assert row["start"] == at and row["doc_tokens"] == len(ids)
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for row in sorted(parts, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_query(spark, folder, texts):
    rows = QUERIES["op6_packing"](spark, folder).collect()
    sequences = packed_right(rows, {k: r["text"] for k, r in texts.items()})
    assert sum(r["length"] for r in rows) > 0.97 * 1024 * sequences


def test_packing_odd_texts(documents):
    odd = {
        1: "", 2: None, 3: "two  spaces   three", 4: " lead and trail ", 5: "tab\t \n mixed   blanks x",
        6: "don't  stop<|endoftext|>here", 7: "日本語 テキスト 123abc", 8: "a\n\n b \n", 9: "x" * 5000, 10: "e " * 3000,
        11: "it's we'll '' ' s", 12: "\u0085 \u001c \u001d", 13: "é" * 40 + " ñ",
    }
    packed_right(packing.pack(documents(*odd.items())).collect(), odd)
    assert packing.pack(documents()).collect() == []


def test_packing_repeated_rows(documents):
    rows = packing.pack(documents((1, "same text"), (1, "same text"), (None, "x"))).collect()
    assert sorted((r["doc_id"] or 0, r["start"]) for r in rows) == [(0, 0), (1, 0), (1, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_demand(seed):
    rng = random.Random(seed)
    demand = {rng.randrange(1, 257): rng.randrange(1, 3000) for _ in range(rng.randrange(1, 200))}
    patterns = packing.cut_patterns(dict(demand), 256)
    held = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(s * c for s, c in pattern.items()) <= 256
        for s, c in pattern.items():
            held[s] += c * times
    assert held == demand
    bound = sum(used for _, used in packing.generate_columns(demand, 256))
    least = max(sum(s * n for s, n in demand.items()) / 256, sum(n for s, n in demand.items() if s > 128))
    assert least <= bound * (1 + 1e-9) and sum(t for _, t in patterns) <= bound + len(demand) + 1


# --- language model ---------------------------------------------------------------


def model_probability(training, order):
    counts = defaultdict(Counter)
    edge = b"\xff"
    for text in training:
        stream = edge * order + text + edge
        for at in range(order, len(stream)):
            for k in range(order + 1):
                counts[stream[at - k : at]][stream[at]] += 1

    def symbol(context, byte):
        excluded, share = set(), 1.0
        while True:
            own = {b: n for b, n in counts.get(context, {}).items() if b not in excluded}
            if own:
                whole = sum(own.values()) + len(own)
                if byte in own:
                    return share * own[byte] / whole
                share *= len(own) / whole
                excluded |= set(own)
            if not context:
                return share / (256 - len(excluded))
            context = context[1:]

    def text(value):
        stream = edge * order + value + edge
        return sum(np.log10(symbol(stream[at - order : at], stream[at])) for at in range(order, len(stream)))

    return text


def test_ppm_against_brute_force(documents):
    rows = [(k, t) for k, t in enumerate(["the cat sat on the mat", "a cat, the hat é", "", None, "tttttt the", "zzz ð the", "x " * 900, "on the cat"] * 3)]
    got = {r["doc_id"]: r for r in ppm.score(documents(*rows), order=3, least_share=0.0).collect()}
    training = [(t or "").encode() for k, t in rows if fold(k, 7) != 2]
    exact = model_probability(training, 3)
    counts = Counter(w for t in training for w in t.lower().split())
    total, kinds = sum(counts.values()) + len(training), len(counts) + 1
    for key, text in rows:
        row, words = got[key], split(text)
        assert row["held_out"] == (fold(key, 7) == 2) and row["n_tokens"] == len(words) + 1
        assert row["train_tokens"] == total and row["n_known"] == 1 + sum(counts[w] > 0 for w in words)
        base = sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        base += np.log10((len(training) + 1) / (total + kinds + 1))
        assert row["base_score"] == pytest.approx(base, abs=1e-9)
        assert row["score"] == pytest.approx(exact((text or "").encode()), rel=1e-5)


def test_ppm_without_training(documents):
    assert ppm.score(documents()).collect() == []
    alone = next(k for k in range(100) if fold(k, 7) == 2)
    row = ppm.score(documents((alone, "two words"))).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["score"] == pytest.approx(-10 * np.log10(256), rel=1e-6)


def test_ppm_query_prefers_text_like_its_training(spark, folder):
    rows = QUERIES["op5_ppm_score"](spark, folder).collect()
    assert len(rows) == 200
    held = [r for r in rows if r["held_out"]]
    # Well under what a byte at random costs, on rows it has not seen.
    assert sum(r["score"] for r in held) > -1.0 * sum(r["n_tokens"] for r in held) * 7 * np.log10(256) / 2


# --- toxicity ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def characters(spark):
    words = "the idiot was a total moron and the clown is worthless but some people like stupid trash here"
    rows = spark.createDataFrame([(f"{words} number {k % 7}",) for k in range(300)], "text string")
    return toxicity.character_model(rows)


@pytest.mark.parametrize(
    "disguised, plain",
    [("1d10t", "idiot"), ("m o r o n", "moron"), ("cl0wn", "clown"), ("w.o.r.t.h.l.e.s.s", "worthless"), ("stuuupid", "stupid"), ("tr@sh", "trash"),
     ("$tupid", "stupid"), ("!diot", "idiot"), ("i d 1 0 t", "idiot"), ("1 d 1 0 t", "idiot"), ("m.0.r.0.n", "moron"),
     ("i  d  i  o  t", "idiot"), ("iiddiioott", "idiot"), ("ѕtupid", "stupid"), ("mоrоn", "moron"), ("worthle55", "worthless"),
     ("m---o---r---o---n", "moron"), ("worthle$$", "worthless")],
)
def test_decoding(characters, disguised, plain):
    assert toxicity.decode(disguised, characters) == plain
    text = f"You {disguised} are here, the {disguised}."
    restored = toxicity.restored([text.encode(), b"plain the words"], characters)
    assert restored[0].decode() == f"You {plain} are here, the {plain}." and restored[1] == b"plain the words"


def test_plain_texts_are_left_alone(characters):
    texts = ["", "The book, 1999; a 3rd one!", "a$$$ of%%% the!! END!!", "in.\nErtion of the", "é ä",
             "v 1.2.3 of 4 - 5 - 6", "1 2 3 4", "I was 5 - 3", "привет мир", "$5 and US$", "Wow!! yes!", "x = 7; -- 8"]
    for text in texts:
        assert toxicity.restored([text.encode()], characters)[0].decode() in (text, text.replace("3rd", "erd"))


def _every_reading(span):
    """All texts behind a span with the channel's log probability, without a search."""
    readings, before = {("", 0.0)}, ""
    for sign in span:
        kind = toxicity._CLASS.get(sign, 1 if sign.isalpha() else 0)
        out = [(sign, 0.0 if kind or sign not in toxicity.LOOK_ALIKE else toxicity.LITERAL)]
        out += [(c, toxicity.SWAPPED) for c in toxicity.LOOK_ALIKE.get(sign) or toxicity.OTHER_SCRIPTS.get(sign, "")]
        if sign in toxicity.SEPARATORS:
            out.append(("", toxicity.SPACED))
        elif sign == before and kind:
            out.append(("", toxicity.REPEATED))
        readings, before = {(text + c, w + v) for text, w in readings for c, v in out}, sign
    return readings


def test_decoding_against_every_path_of_the_lattice(characters):
    rng = random.Random(4)
    kinds = lambda text: [toxicity._CLASS.get(c, 1 if c.isalpha() else 0) for c in text]
    for _ in range(150):
        span = "".join(rng.choice("idotmrn1105$|!@ss .-ѕо") for _ in range(rng.randint(1, 9)))
        weights = {}
        for text, channel in _every_reading(span):
            chain = [0, 0, *kinds(text), 0]
            whole = channel + sum(float(characters[a, b, c]) for a, b, c in zip(chain, chain[1:], chain[2:]))
            weights[text] = max(whole, weights.get(text, -math.inf))
        assert weights[toxicity.decode(span, characters)] >= max(weights.values()) - 1e-6


def test_the_test_of_bytes_misses_no_token(characters):
    rng = random.Random(5)
    decoded = lambda span: toxicity.decode(span, characters)

    def token(match):
        whole = match.group()
        for core in (whole.lstrip(toxicity._TRIM_LEFT).rstrip(toxicity._TRIM_RIGHT), whole.strip(toxicity._TRIM)):
            if toxicity._INSIDE.search(core):
                return whole.replace(core, decoded(core), 1)
        return whole

    def spaced(match):
        letters = [c for c in match.group() if c.isalpha()]
        return decoded(match.group()) if len(letters) >= 2 else match.group()

    texts = ["".join(rng.choices("aidoS éÉñ15$!@.-_ \nѕоЅ€", k=rng.randrange(40))) for _ in range(3000)]
    slow = [toxicity._APART.sub(spaced, toxicity._TOKEN.sub(token, t)) for t in texts]
    fast = toxicity.restored([t.encode() for t in texts], characters)
    assert [f.decode() for f in fast] == slow


def test_toxicity_takes_clashing_columns_and_malformed_text(spark, documents):
    docs = documents(*[(k, f"w{k % 9} worthless" if k % 4 == 0 else f"w{k % 9} kind") for k in range(80)])
    odd = docs.selectExpr(
        "doc_id", "CASE WHEN doc_id = 3 THEN cast(X'FF6162' AS string) WHEN doc_id = 5 THEN repeat('w1 ', 200000) ELSE text END AS text",
        "source", "1 AS toxic", "2 AS _id", "3 AS id", "4 AS weight",
    )
    labels = docs.selectExpr("doc_id", "1 AS quality", "int(text LIKE '%worthless') AS toxic")
    scored = toxicity.score(odd, toxicity.fit(odd, labels)).collect()
    assert len(scored) == 80 and all(r["toxic"] == 1 and r["_id"] == 2 and 0 <= r["toxicity"] <= 1 for r in scored)


def test_toxicity_learns_and_restores(spark, documents):
    rng = random.Random(2)
    good = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        words = rng.choices(good, k=40)
        toxic = k % 5 == 0
        if toxic:
            words.insert(rng.randrange(40), "worthless")
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    rows += [(10_000, "you w0rthl3ss w1 w2"), (10_001, "w1 w2 w3"), (10_002, None), (10_003, ""), (None, "worthless w5")]
    docs = documents(*rows)
    known = spark.createDataFrame(labels + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    scored = toxicity.score(docs.withColumnRenamed("lang", "toxicity"), model)
    assert scored.columns == ["doc_id", "text", "source", "n_chars", "toxicity"]
    got = {r["doc_id"]: r["toxicity"] for r in scored.collect()}
    assert all((got[k] >= 0.5) == (k % 5 == 0) for k in range(600))
    assert got[10_000] >= 0.5 and got[None] >= 0.5
    assert all(0 <= got[k] < 0.5 for k in (10_001, 10_002, 10_003))


def test_toxicity_of_nothing(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents((1, "some text")), none)
    assert toxicity.score(documents((1, "some text")), model).first()["toxicity"] < 0.5
    model = toxicity.fit(documents(), none)
    assert toxicity.score(documents(), model).collect() == []


def test_a_longer_beginning_explains_a_shorter_one():
    bounds = {"lose": 0.8, "loser$": 0.9, "tras": 0.7, "trash$": 0.6, "wort": 0.5}
    weights = {"lose": 10, "loser$": 9.5, "tras": 10, "trash$": 10, "wort": 3}
    assert toxicity._specific(bounds, weights) == {k: v for k, v in bounds.items() if k != "lose"}


def test_toxicity_held_out(spark):
    """On rows it has not learned from: most are told apart."""
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op4_toxicity"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert sum(a == 0 and b == 1 for a, b in held) <= 0.03 * len(held)


def test_ppm_keeps_rare_contexts(documents):
    """A context seen twice among many others costs what all its counts say, held by tasks or joined."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3000)]
    rows = [(k, " ".join(words[5 * k % 3000 : 5 * k % 3000 + 40])) for k in range(1500)]
    exact = model_probability([t.encode() for k, t in rows if fold(k, 7) != 2], ppm.ORDER)
    for hot in (ppm.HOT, 500, 0):
        got = {r["doc_id"]: r["score"] for r in ppm.score(documents(*rows), hot=hot).collect()}
        for key, text in rows[::50]:
            assert got[key] == pytest.approx(exact(text.encode()), rel=1e-9)


def test_prefixes_are_tested_again_only_after_leaders_that_link(spark, monkeypatch):
    """20 sets of their own and 20 pairs that share half, so nothing is linked."""
    rows = [(0, k, [1000 * k + i for i in range(20)]) for k in range(20)]
    for k in range(20, 40):
        shared = [1000 * k + i for i in range(10)]
        rows += [(0, 2 * k, shared + [1000 * k + 100 + i for i in range(10)]), (0, 2 * k + 1, shared + [1000 * k + 200 + i for i in range(10)])]
    sets = spark.createDataFrame(rows, "cluster long, node long, shingles array<long>")
    tested, plain = [], near_dedup._alone
    monkeypatch.setattr(near_dedup, "_alone", lambda compared: tested.append(1) or plain(compared))
    left, links = near_dedup._resolved(sets, 85, 16)
    assert links.count() == 0 and {r["node"] for r in left.collect()} >= set(range(40, 80))
    assert len(tested) == 1
