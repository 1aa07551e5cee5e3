"""Language-model scoring by prediction by partial matching over bytes.

The bytes that follow each context of up to ``ORDER`` bytes are counted over
all training texts; every context seen is a node. A byte's probability is its
count in the longest node (method C escapes: a new symbol counts like one more
of each distinct symbol), or the escape's times that of the next shorter node,
where symbols of the longer nodes are excluded; below the empty context all
bytes left are alike.

The cost of a byte follows from it and the ``ORDER`` bytes before it, its gram.
The costs of the distinct grams of all texts are a table: it is built length by
length, each gram joined to the one that is a byte shorter, and no node passes
the driver. Texts look up the ``HOT`` commonest grams, which every task holds;
their other grams are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.llm.arrow import slices
from sparkclaims.storage import materialize

ORDER = 5
#: Ends a text and stands before it; no UTF-8 text has this byte.
EDGE = 0xFF
#: Words whose counts every task holds; the counts of others are joined.
FREQUENT = 50_000
#: Grams whose costs every task holds, at most; the costs of others are joined.
HOT = 1 << 20
_MOST_WORDS = 300_000
_MOST_GRAMS = 2_000_000


def is_held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Rows kept out of training; a null id has crc32 of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


# --- counting ---------------------------------------------------------------


def _stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with ``order`` edges around each, and where each text begins."""
    edge = bytes([EDGE]) * order
    data = np.frombuffer(edge + b"".join(t + edge for t in texts), np.uint8)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    return data, order + np.concatenate(([0], np.cumsum(sizes + order)[:-1]))


def _places(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the bytes of all texts, each with its one end."""
    runs = sizes + 1
    offset = np.cumsum(runs) - runs
    return np.repeat(begin - offset, runs) + np.arange(int(runs.sum()))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, number = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, number = key[order], number[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(number, first)


def _grams(data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The bytes at these places as numbers, each with the ``order`` bytes before it above it."""
    wide = np.zeros(len(data), np.int64)
    for back in range(order + 1):
        wide[order:] |= data[order - back : len(data) - back].astype(np.int64) << (8 * back)
    return wide[at]


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """gram (order + 1 bytes as a number), n in rows that are not held out, seen in all rows of ``texts`` (text, held_out)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []

        def rows() -> pa.RecordBatch:
            key, number = _merged(keys, counts)
            trained = np.where(key & 1, 0, number)
            return pa.RecordBatch.from_arrays(
                [pa.array(key >> 1, pa.int64()), pa.array(trained, pa.int64()), pa.array(number, pa.int64())],
                ["gram", "n", "seen"],
            )

        for rows_, part in slices(batches, "text"):
            data, begin = _stream(part, order)
            sizes = np.fromiter((len(t) for t in part), np.int64, len(part))
            held = np.array(rows_.column(rows_.schema.get_field_index("held_out")).to_pylist(), np.int64)
            wide = (_grams(data, _places(begin, sizes), order) << 1) | np.repeat(held, sizes + 1)
            key, number = np.unique(wide, return_counts=True)
            keys.append(key)
            counts.append(number)
            if sum(map(len, keys)) > _MOST_GRAMS:
                merged = _merged(keys, counts)
                keys[:], counts[:] = [merged[0]], [merged[1]]
                if len(merged[0]) > _MOST_GRAMS // 2:
                    yield rows()
                    keys.clear()
                    counts.clear()
        if keys:
            yield rows()

    return (
        texts.mapInArrow(count, "gram long, n long, seen long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    )


def token_counts(texts: DataFrame) -> DataFrame:
    """token (bytes of a lower-cased word), c over all rows of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "c"]
            )

        for _, part in slices(batches, "text"):
            for text in part:
                seen.update(text.lower().split())
            if len(seen) > _MOST_WORDS:
                yield rows()
                seen.clear()
        if seen:
            yield rows()

    return texts.mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


# --- costs --------------------------------------------------------------------


def gram_costs(grams: DataFrame, order: int, least_share: float = 0.0) -> DataFrame:
    """gram, seen, cost (log10 probability of its last byte) of each row of ``grams`` (gram, n, seen).

    A context is a node if it has a training byte, and at least ``least_share``
    of them. Of a node come ``of``, the bytes after it, ``kinds``, the distinct ones, and ``shared``, how
    often these follow the context that is a byte shorter: an escape from there
    leaves them out. ``down`` is the sum of the
    escapes from all shorter contexts on the way to the empty one, ``rest`` what
    a byte not seen after the context costs beyond the escapes that lead to it.
    """
    shorter = lambda length: F.col("gram").bitwiseAND(F.lit((1 << (8 * (length + 1))) - 1))
    levels = [grams]
    for length in reversed(range(order)):
        rows = levels[0].groupBy(shorter(length).alias("gram")).agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
        levels.insert(0, materialize(rows, "grams"))
    total = levels[0].agg(F.sum("n")).first()[0] or 0

    # A context has at most 256 rows, and a gram at most 256 that are a byte longer.
    context = Window.partitionBy(F.shiftright("gram", 8))
    trained = F.col("n") > 0
    is_node = (F.col("of") > 0) & (F.col("of") >= F.lit(float(least_share * total)))
    # The logarithm of 0 is null, and no such value is used.
    whole = F.log10(F.col("of") + F.col("kinds"))
    found = F.log10("n") - whole
    escape = F.log10("kinds") - whole
    counted = [F.sum("n").over(context).alias("of"), F.count(F.when(trained, 1)).over(context).alias("kinds")]
    below = (
        levels[0]
        .select("*", *counted)
        .select("*", F.lit(0.0).alias("down"), (-F.log10(256 - F.col("kinds"))).alias("rest"))
        .withColumn("cost", F.when(~is_node, F.lit(-float(np.log10(256)))).when(trained, found).otherwise(escape + F.col("rest")))
    )
    for length in range(1, order + 1):
        parent = below.select(*[F.col(c).alias(f"p_{c}") for c in below.columns if c != "seen"])
        joined = levels[length].join(parent, shorter(length - 1) == F.col("p_gram")).select(
            "*", *counted, F.sum(F.when(trained, F.col("p_n")).otherwise(0)).over(context).alias("shared")
        )
        kinds_left = F.col("p_kinds") - F.col("kinds")
        left = F.col("p_of") - F.col("shared") + kinds_left
        below = (
            joined.withColumn("down", F.col("p_down") + F.when(kinds_left > 0, F.log10(kinds_left) - F.log10(left)).otherwise(0.0))
            .withColumn("rest", F.when(F.col("p_n") > 0, F.log10("p_n") - F.log10(left) - F.col("down")).otherwise(F.col("p_rest")))
            .withColumn("cost", F.when(~is_node, F.col("p_cost")).when(trained, found).otherwise(escape + F.col("down") + F.col("rest")))
            .select(*below.columns)
        )
    return below.select("gram", "seen", "cost")


class Hot(NamedTuple):
    """Costs by gram, ascending, and for each slot of a hash the place of one of its grams."""

    gram: np.ndarray
    cost: np.ndarray
    slot: np.ndarray

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cost of each gram, 0 for those not held, and which are not."""
        if not len(self.gram):
            return np.zeros(len(grams)), np.ones(len(grams), bool)
        place = self.slot[_slots(grams, len(self.slot))]
        missed = np.flatnonzero(self.gram[place] != grams)
        # A slot has one gram; others with it are searched for.
        other, at = np.unique(grams[missed], return_inverse=True)
        place[missed] = np.minimum(np.searchsorted(self.gram, other), len(self.gram) - 1)[at]
        absent = np.zeros(len(grams), bool)
        absent[missed] = self.gram[place[missed]] != grams[missed]
        return np.where(absent, 0.0, self.cost[place]), absent


def _slots(grams: np.ndarray, size: int) -> np.ndarray:
    spread_ = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread_ >> np.uint64(65 - size.bit_length())).astype(np.int64)


def hot_costs(costs: DataFrame, most: int) -> Hot:
    """The commonest grams of ``costs``, as many as have their rank among ``most``."""
    step = F.floor(F.log2("seen") * 8)
    # At most eight rows per doubling of the largest count.
    bars = sorted(((r["step"], r["count"]) for r in costs.groupBy(step.alias("step")).count().collect()), reverse=True)
    least, held = None, 0
    for bar, count in bars:
        held += count
        if held > most:
            break
        least = bar
    # At most ``most`` rows of three numbers.
    table = costs.filter(step >= F.lit(least) if least is not None else F.lit(False)).toArrow()
    gram, cost, seen = (table.column(c).to_numpy() for c in ("gram", "cost", "seen"))
    order = np.argsort(gram)
    gram, cost, seen = gram[order], cost[order], seen[order]
    slot = np.zeros(1 << max(8, (4 * len(gram)).bit_length()), np.int32)
    # The commonest gram of a slot is written last.
    common = np.argsort(seen, kind="stable")
    slot[_slots(gram[common], len(slot))] = common
    return Hot(gram, cost, slot)


# --- scoring ----------------------------------------------------------------


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    least_share: float = 0.0,
    hot: int = HOT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    ``score`` is the log10 probability of the text's bytes and its end under
    the counts of the rows that are not held out; ``base_score`` that of its
    lower-cased words and one end by their counts there, one added to each. A
    null text is empty: it has its end alone. Rows with a null id are scored;
    repeated rows each. With nothing to train on, all bytes are alike and no
    token is known. Other columns are not looked at; no rows give none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "held_out", is_held_out(F.col("doc_id"))
    )
    training = rows.filter(~F.col("held_out")).select("text")
    counts = materialize(token_counts(training), "tokens")
    words, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = training.count()
    total, kinds = words + ends, kinds + (ends > 0)
    below = np.log10(total + kinds + 1)
    end_cost = float(np.log10(ends + 1) - below)

    frequent = counts.orderBy(F.col("c").desc(), "token").limit(FREQUENT)
    table = frequent.toPandas()
    known = spark.sparkContext.broadcast(dict(zip(map(bytes, table["token"]), table["c"].tolist())))
    grams = materialize(gram_counts(rows.select("text", "held_out"), order), "grams")
    costs = materialize(gram_costs(grams, order, least_share), "costs")
    common = spark.sparkContext.broadcast(tuple(hot_costs(costs, hot)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_counts, held = known.value, Hot(*common.value)
        log = {word: float(np.log10(c + 1)) for word, c in frequent_counts.items()}
        get = log.get
        for part, texts in slices(batches, "text"):
            tokens, seen, base = [], [], []
            rare, rare_n, rare_of = [], [], [0]
            for text in texts:
                own = Counter(text.lower().split())
                hit, total_log, n = 0, 0.0, 0
                for word, times in own.items():
                    n += times
                    value = get(word)
                    if value is None:
                        rare.append(word)
                        rare_n.append(times)
                    else:
                        hit += times
                        total_log += times * value
                tokens.append(n)
                seen.append(hit)
                base.append(total_log)
                rare_of.append(len(rare))
            data, begin = _stream(texts, order)
            sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 1
            own = _grams(data, _places(begin, sizes - 1), order)
            found, absent = held.find(own)
            ends_ = np.cumsum(sizes)
            cold_of = np.concatenate(([0], np.cumsum(absent)[ends_ - 1]))
            entries = pa.StructArray.from_arrays(
                [pa.array(rare, pa.binary()), pa.array(rare_n, pa.int64())], ["token", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array(tokens, pa.int64()),
                    pa.array(seen, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rare_of, pa.int32()), entries),
                    pa.ListArray.from_arrays(pa.array(cold_of, pa.int32()), pa.array(own[absent], pa.int64())),
                    pa.array(np.add.reduceat(found, ends_ - sizes), pa.float64()),
                ],
                ["doc_id", "held_out", "words", "known", "base", "rare", "cold", "score"],
            )

    read_rows = materialize(
        rows.mapInArrow(
            read,
            "doc_id long, held_out boolean, words long, known long, base double, "
            "rare array<struct<token:binary,times:bigint>>, cold array<bigint>, score double",
        ).withColumn("row_no", F.monotonically_increasing_id()),
        "scored",
    )
    rare = read_rows.select("row_no", F.explode("rare").alias("r")).select("row_no", "r.*")
    met = (
        rare.join(counts, "token")
        .groupBy("row_no")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_base"),
        )
    )
    more = (
        read_rows.select("row_no", F.explode("cold").alias("gram"))
        .join(costs, "gram")
        .groupBy("row_no")
        .agg(F.sum("cost").alias("more_score"))
    )
    hit = F.col("known") + F.coalesce("more_known", F.lit(0))
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("words") * F.lit(float(below)) + F.lit(end_cost)
    return read_rows.drop("rare", "cold").join(met, "row_no", "left").join(more, "row_no", "left").select(
        "doc_id",
        "held_out",
        (F.col("words") + 1).alias("n_tokens"),
        (hit + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
