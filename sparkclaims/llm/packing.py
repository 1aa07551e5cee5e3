"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into full pieces of the capacity, which are sequences
by themselves, and one remainder. The remainders' lengths, rounded up to a
multiple of ``STEP``, give a histogram of at most capacity / STEP bins. The
linear program over patterns (how many pieces of each length share a sequence)
is solved by column generation: a revised simplex holds the patterns in use
and a knapsack by dynamic programming prices new ones. The program's size
depends on the number of bins only, never on that of documents. Its solution
is rounded down, what is left is filled largest first, and the pieces, ranked
within their bin, take the places of the patterns.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.llm.arrow import slices
from sparkclaims.storage import local_table, materialize

CAPACITY = 1024
STEP = 4
END = 0
# Relative distance to the program's bound at which column generation stops.
GAP = 2e-4
# Pieces of text kept with their ids by a worker, and the longest of them.
CACHED, CACHED_CHARS = 400_000, 32
_SPECIAL = "<|endoftext|>"
# A run of blanks with two spaces is not a matter of one space-separated part.
_ODD = re.compile(r" \s* ")

Pattern = tuple[dict[int, int], int]


class _Parts(dict):
    """Ids, as bytes, of a part of a text that follows a space."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encode(" " + part)).tobytes()
        if len(self) < CACHED and len(part) <= CACHED_CHARS:
            self[part] = ids
        return ids


@functools.cache
def _encoder(path: str, ranks: str):
    """Text to the bytes of its unsigned 32-bit ids.

    Byte-level BPE never merges across the pattern's pieces, and no piece
    crosses a single space except to start with it. So a text is encoded by its
    space-separated parts, most of which repeat. Texts with odd blanks or with
    the text of a special token go to the tokenizer whole.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    parts = _Parts(plain.encode_ordinary)
    get = parts.__getitem__

    def encode(text: str) -> bytes:
        if _SPECIAL in text or _ODD.search(text):
            return array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return array("I", plain.encode_ordinary(first)).tobytes() + b"".join(map(get, rest))

    return encode


def tokenizer_paths() -> tuple[str, str]:
    """The tokenizer's file and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, paths: tuple[str, str], capacity: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece."""
    end = array("I", [END]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(*paths)
        for part, texts in slices(batches, "text"):
            owner, start, length, crc, tokens = [], [], [], [], []
            for at, text in enumerate(texts):
                ids = encode(text.decode("utf-8", "replace")) + end
                n = len(ids) // 4
                for begin in range(0, n, capacity):
                    piece = ids[4 * begin : 4 * (begin + capacity)]
                    owner.append(at)
                    start.append(begin)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, pa.int64()) for c in (start, length, crc, tokens)]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def _knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the largest value, each size as often as it fits."""
    by_size = np.full(capacity + 1, -1.0)
    item = np.full(capacity + 1, -1)
    by_size[sizes], item[sizes] = values, np.arange(len(sizes))
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        gain = by_size[1 : room + 1] + best[room - 1 :: -1][:room]
        at = int(gain.argmax())
        if gain[at] > best[room - 1]:
            best[room], choice[room] = gain[at], at + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[item[choice[room]]] += 1
            room -= choice[room]
    return float(best[capacity]), pattern


def generate_columns(demand: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses them; sizes ascending."""
    sizes = np.array(sorted(demand))
    wanted = np.array([float(demand[s]) for s in sizes])
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    used = wanted / np.diag(columns)
    # A degenerate program may not move; it is not followed forever.
    for _ in range(50 * m + 1000):
        duals = inverse.sum(axis=0)
        value, pattern = _knapsack(duals, sizes, capacity)
        if value <= 1 + 1e-9 or 1 - 1 / value <= gap:
            break
        direction = inverse @ pattern
        grows = direction > 1e-9
        ratio = np.where(grows, used / np.where(grows, direction, 1), np.inf)
        leaves = int(ratio.argmin())
        step = max(ratio[leaves], 0.0)
        used = np.maximum(used - step * direction, 0.0)
        used[leaves] = step
        row = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, row)
        inverse[leaves] = row
        columns[:, leaves] = pattern
    return [(columns[:, k].astype(np.int64), used[k]) for k in range(m)]


def _largest_first(rest: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns for what rounding has left, each filled by the largest sizes that fit."""
    found = []
    while rest:
        room, pattern = capacity, {}
        for size in sorted(rest, reverse=True):
            copies = min(rest[size], room // size)
            if copies:
                pattern[size] = copies
                room -= copies * size
        times = min(rest[s] // c for s, c in pattern.items())
        for size, copies in pattern.items():
            rest[size] -= times * copies
            if not rest[size]:
                del rest[size]
        found.append((pattern, times))
    return found


def cut_patterns(demand: dict[int, int], capacity: int, gap: float = GAP) -> list[Pattern]:
    """Patterns with whole numbers of sequences that hold the demand exactly."""
    demand = {s: n for s, n in demand.items() if n}
    if not demand:
        return []
    sizes = sorted(demand)
    rest, found = dict(demand), []
    for column, used in generate_columns(demand, capacity, gap):
        pattern = {s: int(c) for s, c in zip(sizes, column) if c}
        times = min([int(used + 1e-9), *(rest[s] // c for s, c in pattern.items())])
        if times > 0:
            found.append((pattern, times))
            for s, c in pattern.items():
                rest[s] -= times * c
    return found + _largest_first({s: n for s, n in rest.items() if n}, capacity)


def _places(patterns: list[Pattern]) -> dict[str, list]:
    """Per bin its ranges of ranks: from, to, copies per sequence, first sequence."""
    by_bin: dict[int, list[dict]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        for size, copies in pattern.items():
            begin = filled.get(size, 0)
            filled[size] = begin + times * copies
            by_bin.setdefault(size, []).append(
                {"since": begin, "until": filled[size], "copies": copies, "sequence": sequence}
            )
        sequence += times
    return {"bin": list(by_bin), "places": list(by_bin.values())}


def pack(
    docs: DataFrame,
    paths: tuple[str, str] | None = None,
    capacity: int = CAPACITY,
    step: int = STEP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    A null text is an empty one and has the end id only. Every row of ``docs``
    is packed, repeated ones each; a null id stays null; an empty table gives
    no rows. Sequences are padded to the capacity; their pieces lie gapless
    from 0. Other columns are not looked at.
    """
    if capacity % step:
        raise ValueError("step must divide capacity")
    spark = docs.sparkSession
    cut = materialize(
        pieces(docs, paths or tokenizer_paths(), capacity, id_col, text_col)
        .withColumn("row_no", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id()),
        "pieces",
    )
    size = (F.ceil(F.col("length") / step) * step).cast("int")
    short = cut.filter(F.col("length") < capacity).withColumn("bin", size)
    # At most capacity / step rows.
    counts = short.groupBy("bin", "part").count()
    demand = {row["bin"] // step: row["n"] for row in counts.groupBy("bin").agg(F.sum("count").alias("n")).collect()}
    patterns = [
        ({s * step: c for s, c in pattern.items()}, times) for pattern, times in cut_patterns(demand, capacity // step)
    ]
    total = sum(times for _, times in patterns)
    places = local_table(
        spark,
        _places(patterns),
        "bin int, places array<struct<since:bigint,until:bigint,copies:bigint,sequence:bigint>>",
    )
    # A bin's pieces are numbered per part of the written table; parts add up.
    before = Window.partitionBy("bin").orderBy("part")
    starts = counts.select("bin", "part", (F.sum("count").over(before) - F.col("count")).alias("before"))
    within = Window.partitionBy("bin", "part").orderBy("row_no")
    ranked = (
        short.withColumn("nth", F.row_number().over(within) - 1)
        .join(starts, ["bin", "part"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    rank = F.col("rank")
    place = F.filter("places", lambda p: (rank >= p["since"]) & (rank < p["until"]))[0]
    placed = ranked.join(F.broadcast(places), "bin").withColumn("place", place).select(
        *cut.columns,
        (F.col("place.sequence") + F.floor((rank - F.col("place.since")) / F.col("place.copies"))).alias("sequence_id"),
    )
    # At most ``capacity`` rows per sequence.
    inside = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "row_no")
    packed = placed.withColumn("offset", F.sum("length").over(inside) - F.col("length"))
    full = cut.filter(F.col("length") == capacity).select(
        "*", (F.lit(total) + F.col("row_no")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
