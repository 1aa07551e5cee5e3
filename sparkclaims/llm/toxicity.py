"""Toxicity of restored text: noisy-channel decoding, then a learned word score.

Disguised spans (look-alike signs inside words, letters spaced or dotted
apart, letters repeated) are decoded by a Viterbi search over the lattice of
what each sign may stand for, under a character trigram model of all texts. A
span without such signs has a lattice of one path, so only spans that a quick
test finds are searched. The restored text is scored by its words' beginnings.

The classifier holds for each beginning the lower bound of the share of toxic
documents among those with it. Near copies share one vote, and the bound's
width grows with the number of beginnings tried, so rare chance words stay low.
"""

from __future__ import annotations

import functools
import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.llm import hashing
from sparkclaims.llm.arrow import slices
from sparkclaims.storage import materialize

#: Labelled rows that the classifier is fitted on, at most (about).
SAMPLE_ROWS = 40_000
#: Word beginnings that the classifier holds, at most.
MODEL_SIZE = 50_000
FOLDS, HELD_OUT = 5, 0
SKETCH = 4

# What look-alike signs stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
# Letters of other scripts that look like Latin ones.
OTHER_SCRIPTS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d",
    "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "τ": "t",
}
SEPARATORS = " .-_*"
# Log probabilities of the channel's steps.
SWAPPED, SPACED, REPEATED, LITERAL = -1.0, -1.0, -1.0, -3.0

_LISTED = "abcdefghijklmnopqrstuvwxyz" + "".join(
    c for c in map(chr, range(0xDF, 0x180)) if c.isalpha() and c == c.lower()
)
_CLASS = {c: k + 2 for k, c in enumerate(_LISTED)}
#: Classes of characters: 0 no letter, 1 any other letter, then the listed ones.
CLASSES = len(_LISTED) + 2
_TABLE = np.ones(0x10000, np.int64)
for _code in range(0x250):
    _TABLE[_code] = _CLASS.get(chr(_code).lower()[:1], 1 if chr(_code).isalpha() else 0)
_TABLE[0x2000:0x2070] = 0

_LETTER = "[^\\W\\d_]"
_SIGNS = re.escape("".join(LOOK_ALIKE))
_ALIKE = "".join(OTHER_SCRIPTS)
# Letters or signs set apart by one separator or up to three equal ones.
_ONE = rf"(?:{_LETTER}|[{_SIGNS}])"
_APART = re.compile(rf"(?<!\S){_ONE}(?:([{re.escape(SEPARATORS)}])\1{{0,2}}{_ONE}){{2,}}(?![^\W_])")
_ANY_LETTER = re.compile(_LETTER)
# Signs between letters, a sign before letters, letters three times, two equal signs for a double
# letter at the end, nothing but doubled letters, letters of two scripts.
_INSIDE = re.compile(
    rf"{_LETTER}[{_SIGNS}]+{_LETTER}|^[{_SIGNS}]{_LETTER}{{2}}|({_LETTER})\1\1|{_LETTER}([{_SIGNS}])\2$"
    rf"|^(?:({_LETTER})\3){{3,}}$|[a-z][{_ALIKE}]|[{_ALIKE}][a-z]",
    re.IGNORECASE,
)
_TOKEN = re.compile(r"\S+")
_TRIM = "!?.,;:%*&$#|\"'()[]{}<>"
# Signs that may stand for a word's first or last letters.
_BEFORE, _AFTER = "$!", "$"
_TRIM_LEFT = "".join(c for c in _TRIM if c not in _BEFORE)
_TRIM_RIGHT = "".join(c for c in _TRIM if c not in _AFTER)


_SIGN_BYTES = np.frombuffer("".join(LOOK_ALIKE).encode(), np.uint8)
_SEPARATOR_BYTES = np.frombuffer(SEPARATORS.encode(), np.uint8)
_BLANK_BYTES = np.frombuffer(b" \t\n\v\f\r", np.uint8)


def _decoded(text: bytes) -> str:
    """Malformed bytes are read as U+FFFD, which is no letter."""
    return text.decode("utf-8", "replace")


# --- character model ----------------------------------------------------------


def trigram_counts(texts: DataFrame) -> DataFrame:
    """trigram (of character classes), n over all rows of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for _, part in slices(batches, "text"):
            wide = np.frombuffer(_decoded(b"  ".join(part)).encode("utf-32-le"), np.uint32)
            kind = _TABLE[np.minimum(wide, 0xFFFF)]
            total += np.bincount((kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["trigram", "n"])

    return texts.mapInArrow(count, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def character_model(texts: DataFrame) -> np.ndarray:
    """Log probability of the third class of a trigram, smoothed by shorter contexts."""
    rows = trigram_counts(texts).toPandas()  # at most CLASSES ** 3
    counts = np.zeros((CLASSES,) * 3)
    counts.ravel()[rows["trigram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + CLASSES)
    pairs = counts.sum(0)
    two = (pairs + 5 * one) / (pairs.sum(1, keepdims=True) + 5)
    return np.log((counts + 5 * two[None]) / (counts.sum(2, keepdims=True) + 5)).astype(np.float32)


# --- decoding -----------------------------------------------------------------


def decode(span: str, model: np.ndarray) -> str:
    """The likeliest text behind ``span``, in lower case; a sign that stands for no letter stays.

    The search is exact. A state is the last two classes written: those of the
    last two signs that are no separators, or of a separator, so at most 28.
    """
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    before = ""
    for sign in span.lower():
        kind = _CLASS.get(sign, 1 if sign.isalpha() else 0)
        steps: list[tuple[str, int, float]] = [(sign, kind, 0.0)] if kind else [(sign, 0, LITERAL if sign in LOOK_ALIKE else 0.0)]
        steps += [
            (letter, _CLASS[letter], SWAPPED) for letter in LOOK_ALIKE.get(sign) or OTHER_SCRIPTS.get(sign, "")
        ]
        silent = SPACED if sign in SEPARATORS else REPEATED if sign == before and kind else None
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (weight, text) in states.items():
            options = [(weight + float(model[a, b, k]) + w, (b, k), text + out) for out, k, w in steps]
            if silent is not None:
                options.append((weight + silent, (a, b), text))
            for value, state, out in options:
                if state not in following or following[state][0] < value:
                    following[state] = (value, out)
        states, before = following, sign
    value, text = max((w + float(model[a, b, 0]), out) for (a, b), (w, out) in states.items())
    return text


class Suspects(NamedTuple):
    """Tokens of a batch that may be disguised, in order, and which texts may hold letters set apart."""

    owners: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    apart: np.ndarray


def suspects(texts: list[bytes]) -> Suspects:
    """What may be disguised, by a test of the bytes that misses nothing the patterns find in Latin letters."""
    joined = b" ".join([*texts, b"       "]).lower()
    data = np.frombuffer(joined, np.uint8).copy()
    # Capitals of Latin-1 are two bytes, the second 0x20 below that of the small letter.
    data[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 0x20
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    firsts = np.concatenate(([0], ends[:-1]))
    n = len(data) - 7
    latin, high = (data >= 97) & (data <= 122), data >= 0x80
    letter = latin | high
    sign = np.isin(data, _SIGN_BYTES) & ~letter
    one, separator = letter | sign, np.isin(data, _SEPARATOR_BYTES)
    at = lambda mask, k: mask[k : n + k]
    same = lambda i, k: data[i : n + i] == data[k : n + k]
    # A sign between letters, a sign before letters, letters three times (also of two bytes).
    found = at(letter, 0) & at(sign, 1) & at(one, 2)
    found |= at(sign, 0) & at(letter, 1) & at(letter, 2)
    found |= at(letter, 0) & same(0, 1) & same(1, 2)
    found |= at(data >= 0xC3, 0) & same(0, 2) & same(1, 3) & same(2, 4) & same(3, 5)
    # Two equal signs after a letter, three doubled letters, letters of two scripts; the euro sign.
    found |= at(letter, 0) & at(sign, 1) & same(1, 2) & ~at(one, 3)
    found |= at(latin, 0) & at(latin, 2) & at(latin, 4) & same(0, 1) & same(2, 3) & same(4, 5)
    other = (data >= 0xCE) & (data <= 0xD4)
    found |= (at(latin, 0) & at(other, 1)) | (at(other, 0) & at(latin, 2))
    found |= at(data == 0xE2, 0)
    found[firsts[firsts < n]] = True
    # Single letters and signs set apart by one separator, or by two or three; letters of two bytes.
    apart = ~at(one, 0) & at(one, 1) & at(separator, 2) & at(one, 3) & at(separator, 4) & at(one, 5)
    apart &= at(letter, 1) | at(letter, 3) | at(letter, 5)
    wide = ~at(one, 0) & at(one, 1) & at(separator, 2) & at(separator, 3)
    apart |= wide & at(one, 4) & ~at(one, 5) & (at(letter, 1) | at(letter, 4))
    apart |= wide & at(separator, 4) & at(one, 5) & ~at(one, 6) & (at(letter, 1) | at(letter, 5))
    apart |= at(separator, 0) & at(data >= 0xC3, 1) & at(high & (data < 0xC0), 2) & at(separator, 3)
    hit = np.zeros(len(texts) + 1, bool)
    hit[np.searchsorted(ends, np.flatnonzero(apart), side="right")] = True
    # A text's first letters have no byte before them.
    hit[:-1] |= np.fromiter((_APART.match(_decoded(t[:24])) is not None for t in texts), bool, len(texts))
    # The token of each place found; a place may be the blank before it.
    blanks = np.concatenate(([-1], np.flatnonzero(np.isin(data, _BLANK_BYTES)), [len(data)]))
    places = np.flatnonzero(found)
    places = places + np.isin(data[places], _BLANK_BYTES)
    at_blank = np.unique(np.searchsorted(blanks, places, side="right"))
    begins, stops = blanks[at_blank - 1] + 1, blanks[np.minimum(at_blank, len(blanks) - 1)]
    real = (begins < stops) & (begins < n)
    begins, stops = begins[real], stops[real]
    owners = np.searchsorted(ends, begins, side="right")
    return Suspects(owners, begins - firsts[owners], stops - firsts[owners], hit[:-1])


def restorer(model: np.ndarray) -> Callable[[list[bytes]], list[bytes]]:
    """A function of texts that gives them with their disguised spans restored, all others as they are.

    What a span becomes is remembered for those that come again.
    """
    decoded = functools.lru_cache(20_000)(lambda span: decode(span, model))

    def spaced(match: re.Match) -> str:
        span = match.group()
        return decoded(span) if len(_ANY_LETTER.findall(span)) >= 2 else span

    def single(match: re.Match) -> str:
        whole = match.group()
        for core in (whole.lstrip(_TRIM_LEFT).rstrip(_TRIM_RIGHT), whole.strip(_TRIM)):
            if _INSIDE.search(core):
                begin = whole.index(core)
                return whole[:begin] + decoded(core) + whole[begin + len(core) :]
        return whole

    def restore(texts: list[bytes]) -> list[bytes]:
        out = list(texts)
        owners, begins, ends, apart = suspects(texts)
        edges = np.flatnonzero(np.diff(owners, prepend=-1, append=len(texts)))
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            text, parts, done = texts[owners[first]], [], 0
            for begin, end in zip(begins[first:last].tolist(), ends[first:last].tolist()):
                token = text[begin:end]
                found = _TOKEN.sub(single, _decoded(token)).encode()
                if found != token:
                    parts += [text[done:begin], found]
                    done = end
            if parts:
                out[owners[first]] = b"".join([*parts, text[done:]])
        for k in np.flatnonzero(apart).tolist():
            out[k] = _APART.sub(spaced, _decoded(out[k])).encode()
        return out

    return restore


def restored(texts: list[bytes], model: np.ndarray) -> list[bytes]:
    """The texts with their disguised spans restored; all others as they are."""
    return restorer(model)(texts)


# --- classifier ---------------------------------------------------------------


class Model(NamedTuple):
    characters: np.ndarray
    beginnings: dict[str, float]
    base: float


def beginnings(word: str) -> list[str]:
    """What a word is known by: its first 4, 5 and 6 letters, or its whole if short."""
    found = [word[:k] for k in (4, 5, 6) if len(word) > k]
    if len(word) <= 8:
        found.append(word + "$")
    return found


def _words(text: bytes) -> set[str]:
    return {w.strip(_TRIM) for w in _decoded(text).lower().split()} - {""}


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """text, toxic of at most about ``most`` labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(F.crc32(F.col("_id").cast("string")) % FOLDS != HELD_OUT)
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    count = known.count()
    if count > most:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * most / count))
    # At most about ``most`` rows of two numbers.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(known), texts.id == F.col("_id")).select("text", "toxic")


def _voting(sample: DataFrame, characters) -> DataFrame:
    """text (restored), toxic, weight: near copies share the weight of one."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = restorer(characters.value)
        for part, texts in slices(batches, "text"):
            shingles, starts = hashing.shingles_of(hashing.words_of(texts), 5)
            some = np.diff(starts) > 0
            least = np.zeros((len(texts), SKETCH), np.uint64)
            for k in range(SKETCH):
                values = hashing.mix(shingles ^ hashing.mix(np.full(1, k + 1, np.uint64)))
                if some.any():
                    least[some, k] = np.minimum.reduceat(values, starts[:-1][some])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(least.view(np.int64).ravel()), SKETCH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_decoded(t) for t in restore(texts)]), part.column(1), lists.cast(pa.list_(pa.int64()))],
                ["text", "toxic", "least"],
            )

    rows = materialize(
        sample.mapInArrow(sketch, "text string, toxic int, least array<long>").withColumn(
            "row_no", F.monotonically_increasing_id()
        ),
        "sample",
    )
    votes = rows.select("row_no", F.posexplode("least").alias("k", "value"))
    like = votes.groupBy("k", "value").agg(F.count("*").alias("like"))
    weights = votes.join(like, ["k", "value"]).groupBy("row_no").agg((1 / F.avg("like")).alias("weight"))
    return rows.join(weights, "row_no").select("text", "toxic", "weight")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    model_size: int = MODEL_SIZE,
) -> Model:
    """The character model of all of ``docs`` and the classifier of the labelled rows.

    Labels without an id or a value are left out; of an id with several the
    largest counts. Null texts are empty, malformed bytes U+FFFD; repeated rows
    share the vote of one. Without labelled rows the classifier knows no word.
    Other columns of ``docs``, whatever their names, are not read.
    """
    spark = docs.sparkSession
    characters = character_model(docs.select(F.col(text_col).alias("text")))
    voting = materialize(
        _voting(_sample(docs, labels, id_col, text_col, sample_rows), spark.sparkContext.broadcast(characters)), "voting"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])

        def rows() -> pa.RecordBatch:
            toxic, clean = zip(*seen.values())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen)), pa.array(toxic, pa.float64()), pa.array(clean, pa.float64())],
                ["beginning", "toxic", "clean"],
            )

        for part, texts in slices(batches, "text"):
            for text, toxic, weight in zip(texts, part.column(1).to_pylist(), part.column(2).to_pylist()):
                for known in {b for word in _words(text) for b in beginnings(word)}:
                    seen[known][0 if toxic else 1] += weight
            if len(seen) > 200_000:
                yield rows()
                seen.clear()
        if seen:
            yield rows()

    votes = voting.mapInArrow(count, "beginning string, toxic double, clean double").groupBy("beginning").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    votes = materialize(votes.filter(F.col("toxic") > 0), "votes")
    toxic, whole = voting.agg(
        F.coalesce(F.sum(F.when(F.col("toxic") > 0, F.col("weight"))), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))
    ).first()
    base = (toxic + 0.5) / (whole + 1)
    # So many of the tried beginnings would reach the bound by chance: 0.1.
    z2 = math.log(10 * max(votes.count(), 1)) / -math.log(min(base, 0.9))
    n, p = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    bound = (p + z2 / (2 * n) - F.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)
    best = (
        votes.select("beginning", "toxic", bound.alias("bound"))
        .filter(F.col("bound") > base)
        .orderBy(F.col("bound").desc(), "beginning")
        .limit(model_size)
        .toPandas()
    )
    bounds = dict(zip(best["beginning"], best["bound"].tolist()))
    weights = dict(zip(best["beginning"], best["toxic"].tolist()))
    return Model(characters, _specific(bounds, weights), min(base, 0.49))


def _specific(bounds: dict[str, float], weights: dict[str, float]) -> dict[str, float]:
    """``bounds`` without those beginnings that one longer beginning explains better.

    It has nine tenths of the shorter one's toxic documents and a higher bound:
    other words that begin like the shorter one are then not held against a text.
    """
    explained = {
        shorter
        for longer, bound in bounds.items()
        for shorter in {longer.rstrip("$")[:k] for k in (4, 5, 6)} - {longer}
        if shorter in bounds and bound > bounds[shorter] and weights[longer] >= 0.9 * weights[shorter]
    }
    return {beginning: bound for beginning, bound in bounds.items() if beginning not in explained}


def score_text(text: bytes, known: dict[str, float]) -> float:
    """The bound of the most toxic word; 0 without a known one."""
    return max((known.get(b, 0.0) for word in _words(text) for b in beginnings(word)), default=0.0)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each text, from 0 to 1, in a last column.

    A column of that name is replaced. A text with no known word, an empty and
    a null one score half the share of toxic training rows. Malformed bytes are
    read as U+FFFD. Null ids and repeated rows are scored like others; no rows
    give none. Long texts are scored whole.
    """
    kept = docs.select(*[c for c in docs.columns if c != name])
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        restore = restorer(known.characters)
        memo: dict[str, float] = {}
        get = known.beginnings.get

        def of(word: str) -> float:
            value = max((get(b, 0.0) for b in beginnings(word.strip(_TRIM))), default=0.0)
            if len(memo) < 200_000 and len(word) <= 24:
                memo[word] = value
            return value

        for part, texts in slices(batches, text_col):
            scores = []
            for text in restore(texts):
                top = known.base / 2
                for word in set(_decoded(text).lower().split()):
                    value = memo.get(word)
                    if value is None:
                        value = of(word)
                    if value > top:
                        top = value
                scores.append(top)
            arrays = [part.column(k) for k in range(part.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores, pa.float64())], [*part.schema.names, name])

    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    return kept.mapInArrow(run, schema)
