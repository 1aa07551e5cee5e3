"""Operators that SQL can state: their edge cases, and the queries against the SQL."""

from __future__ import annotations

import hashlib

import check
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as bound
from sparkclaims.llm import exact_dedup, license_scan, line_dedup, mixing, pii, quality_rules
from sparkclaims.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, folder, name):
    assert check.difference(spark, check.duck(folder), folder, name) in ("", "no rows")


def test_exact_groups(documents):
    docs = documents((1, "One text"), (2, "oNE TEXT"), (3, None), (4, ""), (5, "É"), (6, "é"), (None, "one text"), (6, "é"))
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == 8
    by_text = {}
    for row in got:
        by_text.setdefault(row["text_sha256"], []).append(row)
    one = by_text[hashlib.sha256(b"one text").hexdigest()]
    assert {r["doc_id"]: r["kept"] for r in one} == {1: False, 2: True, None: False}
    assert {(r["keep_id"], r["group_size"]) for r in one} == {(2, 3)}
    assert {r["doc_id"]: r["kept"] for r in by_text[hashlib.sha256(b"").hexdigest()]} == {3: False, 4: True}
    assert [r["doc_id"] for r in by_text[hashlib.sha256("É".encode()).hexdigest()]] == [5]
    assert sorted(r["kept"] for r in by_text[hashlib.sha256("é".encode()).hexdigest()]) == [False, True]


def test_exact_groups_beyond_the_summary(documents):
    """Frequent digests and those the summary does not track give the same answer."""
    rows = [(k, "hot") for k in range(40)] + [(100 + k, f"pair {k // 2}") for k in range(100)]
    got = exact_dedup.exact_groups(documents(*rows), tracked=4).collect()
    assert sum(r["kept"] for r in got) == 51
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] < 40} == {(39, 40)}
    assert {r["group_size"] for r in got if r["doc_id"] >= 100} == {2}


def test_exact_groups_of_nothing(documents):
    assert exact_dedup.exact_groups(documents()).collect() == []


def test_boilerplate_goes_by_host(documents):
    rows = [(k, f"common\nown line {k}\n\nlast", "a" if k < 20 else "b") for k in range(25)]
    rows += [(30 + k, f"common\nbody {k}", None) for k in range(40)] + [(99, None, "a"), (98, "", "a")]
    cut = line_dedup.drop_boilerplate(documents(*rows), ratio=0.5)
    got = {r["doc_id"]: r for r in cut.collect()}
    assert got[3]["text"] == "own line 3\n" and (got[3]["lines_before"], got[3]["lines_dropped"]) == (3, 2)
    assert got[22]["text"] == "own line 22\n" and got[31]["text"] == "body 1"
    assert got[99]["text"] is None and (got[99]["lines_before"], got[99]["lines_dropped"]) == (0, 0)
    assert got[98]["text"] == ""
    assert cut.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_lines_of_small_hosts_and_repeats_stay(documents):
    rows = [(1, "twice\ntwice", "x"), (2, "twice", "x")]
    got = line_dedup.drop_boilerplate(documents(*rows)).collect()
    assert {r["text"] for r in got} == {"twice\ntwice", "twice"}
    assert line_dedup.drop_boilerplate(documents()).collect() == []


def test_line_dedup_takes_clashing_columns(documents):
    docs = documents((1, "a b", "x")).selectExpr("*", "7 AS lines_dropped", "source AS host", "text AS key")
    row = line_dedup.drop_boilerplate(docs).first()
    assert row["lines_dropped"] == 0 and row["host"] == "x" and row["key"] == "a b"


def test_lines_of_a_hot_host_without_broadcast(spark, documents, monkeypatch):
    rows = [(k, f"top\nline {k}\nend", "hot" if k % 3 else None if k % 2 else f"h{k % 7}") for k in range(400)]
    docs = documents(*rows).selectExpr("*", "1 AS keys", "2 AS `left`", "3 AS `row`", "4 AS _keys", "5 AS _salt", "6 AS `a.b`")
    whole = sorted(map(tuple, line_dedup.drop_boilerplate(docs).collect()), key=lambda r: r[0])
    assert all(r[1].startswith("line") and r[-1] == 2 for r in whole) and whole[7][5:11] == (1, 2, 3, 4, 5, 6)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(line_dedup, "HOT_PAGES", 50)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cut = line_dedup.drop_boilerplate(docs)
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan and sorted(map(tuple, cut.collect()), key=lambda r: r[0]) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_very_long_and_malformed_lines(spark, documents):
    long = "x " * 300_000
    rows = [(k, f"{long}\n{'y' * 100_000}\nown {k}", "a") for k in range(4)]
    assert {r["text"] for r in line_dedup.drop_boilerplate(documents(*rows)).collect()} == {f"own {k}" for k in range(4)}
    odd = spark.range(4).selectExpr("id AS doc_id", "cast(X'FF6120' AS string) || '\\n' || id AS text", "'a' AS source")
    assert {r["text"] for r in line_dedup.drop_boilerplate(odd).collect()} == set("0123")


def test_host_of(spark):
    df = spark.createDataFrame([("HTTP://WWW.Ex.com:80/a",), ("no url",), (None,)], "url string")
    assert [r[0] for r in df.select(line_dedup.host_of(df.url)).collect()] == ["www.ex.com", None, None]


def test_quality_measures(documents):
    words = [f"w{k}" for k in range(9)]
    rows = [
        (1, " ".join(words + words)),
        (2, "a " * 30),
        (3, None),
        (4, "same line\nsame line\n \nother #*\n"),
        (5, "the of and " * 3 + "x" * 100_000),
    ]
    got = {r["doc_id"]: r for r in quality_rules.judge(documents(*rows)).collect()}
    assert (got[1]["n_words"], got[1]["n_repeat_words"], got[1]["base_failed"]) == (18, 18, True)
    assert (got[2]["n_words"], got[2]["n_repeat_words"]) == (30, 30)
    assert (got[3]["n_words"], got[3]["n_lines"], got[3]["kept"]) == (0, 0, False)
    assert (got[4]["n_dup_lines"], got[4]["n_symbols"], got[4]["n_lines"]) == (1, 2, 3)
    assert got[5]["word_chars"] == 100_024
    assert quality_rules.judge(documents()).collect() == []


def test_quality_keeps_prose(documents):
    prose = " ".join(f"the reader{k} of page{k} found{k} a note{k} that was in it" for k in range(6))
    shout = " ".join(f"THE!! READER!! OF!! PAGE!! {k}!!" for k in range(10))
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(documents((1, prose), (2, shout))).collect()}
    assert got == {1: True, 2: False}


def test_license_edges(documents):
    mit = license_scan.TEMPLATES["MIT"]
    rows = [
        (1, "intro " * 300 + mit + " outro" * 40),
        (2, " ".join(mit.split()[: len(mit.split()) // 2])),
        (3, None),
        (4, "Released under the MIT License."),
        (5, "too short"),
        (None, "x Licensed under the apache LICENSE, version 2.0!"),
    ]
    got = {(r["doc_id"], r["template"]): r for r in license_scan.scan(documents(*rows)).collect()}
    assert set(got) == {(1, "MIT"), (4, "MIT notice"), (None, "Apache-2.0 notice")}
    assert got[1, "MIT"]["containment"] == 1.0 and got[1, "MIT"]["first_word"] <= 300
    assert license_scan.scan(documents()).collect() == []
    assert license_scan.scan(documents(*rows), templates={}).collect() == []


def test_license_lines_of_the_tables_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = docs.filter(F.col("text").rlike("(?i)(licensed|released) under (the|a|cc)"))
    found = {r["doc_id"] for r in license_scan.scan(lines).collect()}
    some = {r["doc_id"] for r in lines.select("doc_id").collect()}
    assert len(some) >= 39 and found == some


def test_each_license_is_told_from_its_kin(documents):
    kin = [n for n in license_scan.TEMPLATES if n.startswith(("CC", "LGPL", "AGPL", "Unlicense", "BSD"))]
    kin.append("GPL-3.0")
    rows = [(k, "intro words here " + license_scan.TEMPLATES[n] + " and more words") for k, n in enumerate(kin)]
    got = sorted((r["doc_id"], r["template"]) for r in license_scan.scan(documents(*rows)).collect())
    assert got == list(enumerate(kin))


def test_license_bands_meet_their_promise():
    miss = (1 - license_scan.LEAST_SIMILARITY) ** license_scan.BANDS
    assert miss <= license_scan.MISS
    for needed in range(1, 400):
        c = license_scan.template_class(needed)
        wide = c + license_scan.stride(c)
        held = -(-needed * 4 // 5)
        assert held / (wide + needed - held) >= license_scan.LEAST_SIMILARITY


# --- mixing -------------------------------------------------------------------


def fill(sizes, share=1.5, most=2):
    """Targets by the rule as stated: share by weight, cut at the cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


def test_mix_meets_its_targets(spark, documents):
    rows = [(k, "w " * (k % 7 + 1), ["a", "b", "c", "d", None][min(4, k % 11 // 2)]) for k in range(400)]
    rows += [(900, None, "a"), (901, "", "b"), (902, "x " * 3000, "c"), (903, "lone word", "é")]
    docs = documents(*rows)
    got = mixing.taken_per_row(*mixing.mix(docs, block_words=50, shards=5)).collect()
    again = mixing.taken_per_row(*mixing.mix(docs, block_words=50, shards=5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    sizes, taken, target = {}, {}, {}
    for row in got:
        s = source[row["doc_id"]]
        assert row["size"] == size[row["doc_id"]] and 0 <= row["taken"] <= 2 * row["size"]
        sizes[s] = sizes.get(s, 0) + row["size"]
        taken[s] = taken.get(s, 0) + row["taken"]
        target[s] = row["target"]
    expected = fill(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s]) and abs(taken[s] - target[s]) < 1.001


def test_shards_are_disjoint_and_even(spark, documents):
    rows = [(k, "w " * 10, "ab"[k % 3 == 0]) for k in range(600)]
    _, copies = mixing.mix(documents(*rows), block_words=100, shards=6)
    copies = copies.collect()
    assert len({(r["row_no"], r["epoch"]) for r in copies}) == len(copies)
    by_shard = {}
    for row in copies:
        by_shard.setdefault(row["shard"], []).append(row["position"])
    assert set(by_shard) == set(range(6))
    for places in by_shard.values():
        assert sorted(places) == list(range(1, len(places) + 1))


def test_splits_follow_the_hypergeometric_law(spark):
    """Mean and deviation of many seeded draws; every draw takes what it should in all."""
    quotas = F.array(*[F.lit(n).cast("long") for n in (30, 50, 20)])
    drawn = spark.range(1, 401).select(
        mixing._left_quotas(quotas, F.lit(50).cast("long"), F.col("id"), 7).alias("left")
    ).collect()
    assert all(sum(r["left"]) == 50 and r["left"][0] <= 30 and r["left"][2] <= 20 for r in drawn)
    # Means n * q / 100 and deviations sqrt(100/99 * p * (1 - p) * 100 / 4).
    for place, mean, deviation in ((0, 15, 2.30), (1, 25, 2.51), (2, 10, 2.01)):
        values = [r["left"][place] for r in drawn]
        found = sum(values) / len(values)
        spread = (sum((v - found) ** 2 for v in values) / len(values)) ** 0.5
        assert abs(found - mean) < 0.5 and abs(spread - deviation) < 0.35


def test_split_quotas_add_up(spark):
    quotas = spark.createDataFrame([("a", 31), ("b", 50), (None, 20)], "source string, quota long")
    rows = mixing.split_quotas(quotas, 5, 1).collect()
    for source, quota in (("a", 31), ("b", 50), (None, 20)):
        ranges = sorted((r["first"], r["last"]) for r in rows if r["source"] == source)
        assert ranges[0][0] == 0 and ranges[-1][1] == quota
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    sizes = {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["last"] - r["first"]
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sum(sizes.values()) == 101


def test_mix_of_nothing(documents):
    rows, copies = mixing.mix(documents())
    assert rows.collect() == [] and copies.collect() == []
    rows, copies = mixing.mix(documents((1, None), (2, " \n")))
    assert len(rows.collect()) == 2 and copies.collect() == []


def test_mixed_documents_cut_a_part(documents):
    rows = [(1, "  one two\tthree\nfour", "a"), (2, "p q r s t u v w", "b"), (3, "k l m n", "c")]
    got = mixing.mixed_documents(documents(*rows)).collect()
    whole = {r[0]: r[1].split() for r in rows}
    for row in got:
        words = row["text"].split()
        assert words == whole[row["doc_id"]][: len(words)] and words
    words = {}
    for row in got:
        words[row["source"]] = words.get(row["source"], 0) + len(row["text"].split())
    for source, target in fill({"a": 4, "b": 8, "c": 4}).items():
        assert abs(words.get(source, 0) - target) <= 1


# --- personal data --------------------------------------------------------------


def test_surrogates_keep_form_and_coreference(documents):
    rows = [
        (1, "Call +1 (743) 555-3824 or mail Jo.Doe@mail.example.com today"),
        (2, "again +1 743 555-3824, JO.DOE@MAIL.EXAMPLE.COM and card 4785 3805 9239 1139"),
        (3, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" from 10.20.30.40'),
        (4, "Mr. Thomas Weber met Thomas Weber and Frau Anna Becker; Анна Шевченко wrote"),
        (5, None),
        (6, "nothing personal in 3 lines"),
        (7, "SSN 123-45-6789 and DE44 5001 0517 5407 3249 31"),
    ]
    got = {r["doc_id"]: r for r in pii.pseudonymise(documents(*rows), "k1").collect()}
    same = {r["doc_id"]: r for r in pii.pseudonymise(documents(*rows), "k1").collect()}
    other = {r["doc_id"]: r for r in pii.pseudonymise(documents(*rows), "k2").collect()}
    assert got == same and got[1]["text"] != other[1]["text"]
    assert got[5]["text"] is None and got[6]["text"] == rows[5][1]
    assert [got[k]["n_mentions"] for k in range(1, 8)] == [2, 3, 2, 4, 0, 0, 2]
    for key, text, *_ in rows:
        for secret in ("743", "555-3824", "Doe@", "DOE@", "4785", "24be64", "10.20.30.40", "Thomas", "Anna", "Шевченко", "6789", "5407"):
            assert secret not in (got[key]["text"] or "")
    assert "Antonio Weber" not in got[4]["text"] and "Becker;" not in got[4]["text"]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    one, two = got[1]["text"], got[2]["text"]
    assert digits(one.split(" or ")[0]) == digits(two.split(",")[0])
    assert one.startswith("Call +") and one[8] == "(" and one.split()[2].endswith(")")
    mail = one.split()[-2]
    assert mail.endswith(".com") and mail.count("@") == 1 and mail[0].isupper() is False
    assert two.split()[4].lower() == mail.lower() and two.split()[4].isupper()
    assert got[3]["text"].split('"')[1].isalnum() and len(got[3]["text"].split('"')[1]) == 40
    names = got[4]["text"]
    first = names.split(" met ")[0].removeprefix("Mr. ")
    assert names.startswith("Mr. ") and f"met {first} and Frau " in names
    assert first.split()[0] in pii.GIVEN["m", "latin"].split()
    assert names.split("Frau ")[1].split()[0] in pii.GIVEN["f", "latin"].split()
    assert names.split("; ")[1].split()[0] in pii.GIVEN["f", "cyrillic"].split()
    assert got[7]["text"].startswith("SSN ") and got[7]["text"].split(" and ")[1][:2] == "DE"


def test_surrogates_never_collide(spark):
    """More persons than pairs of listed names, and numbers that are all entities."""
    people = [("name", f"Anna X{k}y") for k in range(600)]
    numbers = [("ssn", f"{k:09d}") for k in range(500)]
    entities = spark.createDataFrame(people + numbers, "kind string, canon string")
    got = pii.surrogates(entities, "key").collect()
    assert len({(r["kind"], r["surrogate"]) for r in got}) == len(got) == 1100
    known = {(r["kind"], r["canon"]) for r in got}
    assert not any((r["kind"], r["surrogate"]) in known for r in got)
    assert all(r["surrogate"].split()[0] in pii.GIVEN["f", "latin"].split() for r in got if r["kind"] == "name")


def test_pseudonymise_nothing(documents):
    assert pii.pseudonymise(documents(), "k").collect() == []


def test_bound_names():
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in bound.queries() if n.startswith("op")}
    assert "pipeline" in bound.queries()


def test_the_mix_is_the_same_however_the_input_is_cut(spark, documents, tmp_path):
    """Other files, partitions and cores, and rows that are wholly equal among them."""
    rows = [(k % 150, " ".join(f"w{j}" for j in range(k % 13)), ["a", "b", None][k % 3]) for k in range(300)]
    rows += [(7, "equal row of five words", "a")] * 40 + [(None, "no id", "b")] * 3
    path, found = str(tmp_path / "docs"), []
    for files, most in ((1, "128m"), (7, "400"), (40, "10k")):
        documents(*rows).repartition(files).write.mode("overwrite").parquet(path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            taken = mixing.taken_per_row(*mixing.mix(spark.read.parquet(path), block_words=40, shards=5)).drop("first_shard", "first_position")
            whole = mixing.mixed_documents(spark.read.parquet(path), block_words=40, shards=5)
            found.append((sorted(map(tuple, taken.collect()), key=str), [(r["doc_id"], r["text"]) for r in whole.collect()]))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2]


def test_mixed_documents_keep_clashing_columns(documents):
    docs = documents(*[(k, f"a b c {k}", "s") for k in range(20)]).selectExpr(
        "*", "1 AS size", "2 AS words", "3 AS position", "4 AS shard", "5 AS row_no", "6 AS _row", "7 AS place", "8 AS target", "9 AS block"
    )
    got = mixing.mixed_documents(docs)
    rows = got.collect()
    assert got.columns == docs.columns and rows
    assert {tuple(r)[5:] for r in rows} == {(1, 2, 3, 4, 5, 6, 7, 8, 9)}


def test_shards_follow_from_the_blocks(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 2)
    rows = [(k, "w " * 10, "a") for k in range(100)]
    _, copies = mixing.mix(documents(*rows), block_words=20)
    shards = copies.groupBy("shard").agg(F.count("*").alias("n"), F.max("position").alias("last")).collect()
    assert len(shards) > mixing.SHARDS and all(r["n"] == r["last"] for r in shards)


LONG = {
    "name": "John Ab" + "-Ab" * 30_000,
    "email": "x@" + "a." * 40_000 + "com",
    "local": "y" * 100_000 + "@mail.example.com",
    "secret": "24be64439e" * 10_000,
}


def test_very_long_entities(documents):
    rows = [(k, f"see {text} now") for k, text in enumerate(LONG.values())]
    got = {r["doc_id"]: r for r in pii.pseudonymise(documents(*rows), "k").collect()}
    for k, text in enumerate(LONG.values()):
        assert got[k]["n_mentions"] == 1 and text not in got[k]["text"] and got[k]["text"].endswith(" now")


def luhn(digits):
    values = [int(c) * (1 + at % 2) for at, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def test_forms_of_numbers_and_addresses(documents):
    whole = [
        "4111 1111 1111 1111", "4111111111111111", "3782 822463 10005", "+14155552671", "+49 30 1234567", "+33 1 23 45 67 89",
        "030/1234567", "(415) 555-2671", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a", "a@b.example.org",
    ]
    plain = ["12:30:45", "page 3 of 17", "2024-01-15", "a::b", "std::cc::dd", "v1.2.3", "Missing Person"]
    rows = [(k, f"x {text}. y") for k, text in enumerate([*whole, *plain])]
    got = {r["doc_id"]: r for r in pii.pseudonymise(documents(*rows), "k").collect()}
    for k, text in enumerate(whole):
        made = got[k]["text"][2:-3]
        assert got[k]["n_mentions"] == 1 and made != text, text
        if "@" not in text:
            assert [c.isalnum() for c in made] == [c.isalnum() for c in text], (text, made)
        # No group of four characters of the original is left in its place.
        assert not any(made[at : at + 4] == text[at : at + 4] for at in range(len(text) - 3) if text[at : at + 4].isalnum()), (text, made)
    for k in (0, 1, 2):
        assert luhn("".join(c for c in got[k]["text"] if c.isdigit()))
    assert all(got[len(whole) + k]["n_mentions"] == 0 for k in range(len(plain)))


def test_titles_tie_to_the_full_name_of_the_text(documents):
    rows = [
        (1, "Anna Becker came. Frau Becker left."), (2, "Mr Smith and Dr. Weber met Herr Becker."), (3, "Anna Becker and Maria Becker; Frau Becker?"),
        (4, "Mr Becker is not Anna Becker."), (5, "Mr Smith again"),
    ]
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(documents(*rows), "k").collect()}
    first, second = got[1].split(" came. Frau ")
    assert second == f"{first.split()[-1]} left." and "Becker" not in got[1] and "Anna" not in got[1]
    assert not any(name in " ".join(got.values()) for name in ("Mr Smith", "Dr. Weber", "Herr Becker", "Frau Becker", "Mr Becker"))
    assert got[2].split(" and ")[0] == got[5].removesuffix(" again")
    assert got[4].endswith(f"is not {first}.") and got[3].startswith(first)


def test_personal_data_by_brute_force(documents):
    """Every text is its own with each mention found by the pattern replaced by the surrogate of that mention."""
    import regex

    texts = [
        "Write John Miller, +1 743 555-3824, or jo@ex.com; John Miller (Mr Miller) pays by 4111 1111 1111 1111.",
        "jo@ex.com and JO@EX.COM from 10.0.0.1", "nothing", "Mr Miller alone, 10.0.0.1", "sk_0123456789abcdef0123 twice sk_0123456789abcdef0123",
    ]
    got = [r["text"] for r in sorted(pii.pseudonymise(documents(*enumerate(texts)), "k").collect(), key=lambda r: r["doc_id"])]
    seen, patterns = {}, regex.compile(pii.ANY)
    for text, made in zip(texts, got, strict=True):
        pieces, at = patterns.split(text), 0
        mentions = [m.group() for m in patterns.finditer(text)]
        assert made.startswith(pieces[0]) and (mentions or made == text)
        for k, mention in enumerate(mentions):
            at += len(pieces[k])
            end = made.index(pieces[k + 1], at + 1) if pieces[k + 1] else len(made)
            titled = mention == "Mr Miller" and "John Miller" in mentions
            assert seen.setdefault((mention, titled), made[at:end]) == made[at:end] != mention
            at = end
    assert len(set(seen.values())) == len(seen)
