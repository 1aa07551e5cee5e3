"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the whole text; no user function
runs. A rule bounds a ratio of two measures, and the verdict of a document is
the conjunction of the compiled rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.llm.words import BLANK_RUN, WORD, bind, words

WINDOW = 8


class Rule(NamedTuple):
    """``least <= numerator / denominator <= most``; true where the denominator is 0."""

    name: str
    numerator: str
    denominator: str
    least: float | None
    most: float | None


# Published heuristics of web-text filters: word counts and lengths, symbols
# and capitals per word, stop words, repeated and bulleted lines.
RULES = (
    Rule("word_count", "n_words", "one", 20, 1_000_000),
    Rule("word_length", "word_chars", "n_words", 2, 15),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", None, 0.2),
    Rule("capital_share", "n_capitals", "word_chars", None, 0.5),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.01, None),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.3),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", None, 0.3),
)

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "das dem den der des die ein eine für im ist mit nicht und von zu "
    "au avec dans de des du elle en est et la le les pour que qui sur un une "
    "con del el es las los no para por se su y"
).split()


def _repeated_words(window_hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def covered(ordered: Column) -> Column:
        def twice(entry: Column, at: Column) -> Column:
            same = lambda other: F.coalesce(F.get(ordered, other)["h"] == entry["h"], F.lit(False))
            return same(at - 1) | same(at + 1)

        starts = F.sort_array(F.transform(F.filter(ordered, twice), lambda entry: entry["p"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda seen, start: F.struct(
                (seen["total"] + start + WINDOW - F.greatest(seen["end"], start)).alias("total"),
                (start + WINDOW).alias("end"),
            ),
            lambda seen: seen["total"].cast("long"),
        )

    pairs = F.transform(window_hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    return F.when(
        F.size(F.array_distinct(window_hashes)) == F.size(window_hashes), F.lit(0).cast("long")
    ).otherwise(bind(F.sort_array(pairs), covered))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measures that rules may name, one row per document.

    A null text has no words and no lines. Windows of eight words are compared
    by a 64-bit hash within their document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        words(F.col(text_col)).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    hashed = split.withColumn(
        "windows",
        F.when(
            F.size("words") > WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - WINDOW + 1),
                lambda start: F.xxhash64(F.slice("words", start, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern)).cast("long")

    def lines(pattern: str) -> Column:
        return F.size(F.filter("lines", lambda line: line.rlike(pattern))).cast("long")

    return hashed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", BLANK_RUN, "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("windows")).alias("n_repeat_words"),
        count("!").alias("n_exclamations"),
        count("[A-ZÀ-ÖØ-Þ]").alias("n_capitals"),
        F.size(F.filter("words", lambda word: F.lower(word).isin(*STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        lines(r"^[ \t]*[-*•]").alias("n_bullet_lines"),
        lines(r"(\.\.\.|…)[ \t\r]*$").alias("n_ellipsis_lines"),
    )


def compiled(rule: Rule) -> Column:
    """A rule as a boolean expression over the measures."""
    numerator = F.col(rule.numerator).cast("double")
    denominator = F.lit(1.0) if rule.denominator == "one" else F.col(rule.denominator).cast("double")
    holds = F.lit(True)
    if rule.least is not None:
        holds = holds & (numerator >= F.lit(float(rule.least)) * denominator)
    if rule.most is not None:
        holds = holds & (numerator <= F.lit(float(rule.most)) * denominator)
    return holds


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures, ``base_failed``, one ``ok_<rule>`` per rule, and ``kept``.

    One row per row of ``docs``, null and repeated ids included; an empty table
    gives no rows. Documents under 20 words, or with more than 30 % of their
    words in repeated windows, fail before any rule.
    """
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    verdicts = [compiled(rule).alias(f"ok_{rule.name}") for rule in rules]
    ruled = measures(docs, id_col, text_col).select("*", base_failed.alias("base_failed"), *verdicts)
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(f"ok_{rule.name}")
    return ruled.withColumn("kept", kept)
