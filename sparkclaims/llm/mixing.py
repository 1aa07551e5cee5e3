"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut in blocks of its rows, in an order that a keyed hash
permutes. A source's quota is the number of blocks that its target takes (a
source that repeats takes its blocks again in the next epoch; the last block
may be taken in part, so the words come to the target exactly). The tree
starts from the quotas of all sources and halves them down to the output
shards: how many blocks of each source go left is drawn from the multivariate
hypergeometric law, so a shard is a random mix whose quotas add up exactly.
A shard then takes its disjoint range of each source's permuted blocks, and
its rows are shuffled among themselves.

Everything after the word counts runs on short rows without texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.llm.words import BLANK_RUN, BLANKS, WORD, bind
from sparkclaims.operators.joins import skew_join
from sparkclaims.operators.positions import running_sums
from sparkclaims.storage import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
BLOCK_WORDS = 50_000
# Shards at least, and blocks of a shard.
SHARDS, SHARD_BLOCKS = 16, 64
SEED = 20_240_601
# Blocks of a source per group of the two-step running sum.
_GROUP = 1_000
# Standard deviations around the mode that a draw can reach (2e-33 beyond).
_REACH = 12


def sized_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """doc_id, source, size (words), row_no and ``place`` of each row, written once.

    ``row_no`` (``row_col`` if given) only tells rows apart. ``place`` is what
    decides a row's blocks and order: a digest of id, source and text, with a
    number that tells equal rows apart. It does not depend on how files are split.
    """
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    content = [F.col(id_col), F.col(source_col), F.col(text_col)]
    absent = [c.isNull() for c in content]
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            number.alias("row_no"),
            F.xxhash64(F.lit(1), *absent, *content).alias("digest_1"),
            F.xxhash64(F.lit(2), *absent, *content).alias("digest_2"),
        ),
        "sizes",
    )
    digest = ["digest_1", "digest_2"]
    repeated = materialize(rows.groupBy(*digest).agg(F.count("*").alias("_rows")).filter("_rows > 1"), "repeated")
    place = lambda tie: F.xxhash64(*digest, tie).alias("place")
    if not repeated.limit(1).count():
        return rows.select("doc_id", "source", "size", "row_no", place(F.lit(0).cast("long")))
    flagged = materialize(skew_join(rows, repeated, digest, "left", frequencies=lambda: repeated), "flagged")
    # Equal rows are interchangeable; they are counted in blocks, however many.
    numbered = running_sums(flagged.filter("_rows IS NOT NULL").drop("_rows"), digest, ["row_no"], {"_tie": F.lit(1).cast("long")})
    single = flagged.filter("_rows IS NULL").drop("_rows").withColumn("_tie", F.lit(0).cast("long"))
    return materialize(
        single.unionByName(numbered).select("doc_id", "source", "size", "row_no", place(F.col("_tie"))), "numbered"
    )


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target of each source.

    Sources in code-point order, null last, weigh ``weights`` in turn. The
    targets share ``share`` of all words; a target stops at ``most`` times its
    source's size and the excess is shared again by weight until none is over.
    One row per source is ranked here, not the rows of a source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = materialize(
        sums.select(
            "source",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")).alias("weight"),
        ),
        "sources",
    )
    cap = F.col("source_size") * most
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # The level at which the sources not yet at their cap share what is left.
        full = cap <= F.col("weight") * F.lit(level)
        capped, open_weight = table.agg(
            F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        next_level = (share * total - (capped or 0)) / open_weight
        if next_level <= level:
            break
        level = next_level
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def _uniform(*parts) -> Column:
    """A number in (0, 1) that the parts decide."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double")
    return (bits + 0.5) / float(1 << 53)


def _hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` blocks out of good + bad are good, at quantile ``u``.

    Exact inversion: the weights of the outcomes follow by their ratios from
    the mode, which counts as 1; outcomes beyond 12 deviations weigh nothing
    in double precision.
    """
    n = good + bad
    low = F.greatest(F.lit(0).cast("long"), draws - bad)
    high = F.least(good, draws)
    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (good + 1) / (n + 2)).cast("long")))
    share = good / F.greatest(n, F.lit(1))
    deviation = F.sqrt(draws * share * (1 - share) * (n - draws) / F.greatest(n - 1, F.lit(1)))
    width = F.ceil(deviation * _REACH).cast("long") + 1
    range_ = F.struct(
        mode.alias("mode"),
        F.greatest(low, mode - width).alias("first"),
        F.least(high, mode + width).alias("last"),
        u.alias("u"),
    )
    return bind(range_, lambda r: _outcome(good, bad, draws, r))


def _outcome(good: Column, bad: Column, draws: Column, range_: Column) -> Column:
    mode, first, last = range_["mode"], range_["first"], range_["last"]
    up = lambda k: (good - k + 1).cast("double") * (draws - k + 1) / (k.cast("double") * (bad - draws + k))

    def grow(values: Column, step) -> Column:
        return F.aggregate(
            values,
            F.struct(F.lit(1.0).alias("w"), F.array(F.lit(1.0)).alias("all")),
            lambda acc, k: F.struct(
                (acc["w"] * step(k)).alias("w"), F.concat(acc["all"], F.array(acc["w"] * step(k))).alias("all")
            ),
            lambda acc: acc["all"],
        )

    steps = lambda a, b, by: F.when(a <= b if by > 0 else a >= b, F.sequence(a, b, F.lit(by).cast("long"))).otherwise(
        F.array().cast("array<long>")
    )
    above = grow(steps(mode + 1, last, 1), up)
    below = grow(steps(mode, first + 1, -1), lambda k: 1 / up(k))
    weights = F.concat(F.reverse(F.slice(below, 2, F.greatest(F.size(below) - 1, F.lit(0)))), above)
    return bind(weights, lambda w: F.least(last, first + _quantile(w, range_["u"])))


def _quantile(weights: Column, u: Column) -> Column:
    """How many outcomes lie wholly below the quantile."""
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    return bind(
        total * u,
        lambda mark: F.aggregate(
            weights,
            F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below")),
            lambda acc, w: F.struct(
                (acc["sum"] + w).alias("sum"),
                (acc["below"] + F.when(acc["sum"] + w < mark, 1).otherwise(0)).alias("below"),
            ),
            lambda acc: acc["below"],
        ),
    )


def _left_quotas(quotas: Column, left: Column, node: Column, seed: int) -> Column:
    """Blocks of each source in ``left`` blocks drawn from all of a node."""
    start = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q).alias("rest"),
        left.alias("draws"),
        F.array().cast("array<long>").alias("taken"),
    )

    def draw(acc: Column, good: Column) -> Column:
        place = F.size(acc["taken"])
        taken = _hypergeometric(good, acc["rest"] - good, acc["draws"], _uniform(F.lit(seed), node, place))
        return F.transform(
            F.array(taken),
            lambda t: F.struct(
                (acc["rest"] - good).alias("rest"),
                (acc["draws"] - t).alias("draws"),
                F.concat(acc["taken"], F.array(t)).alias("taken"),
            ),
        )[0]

    return F.aggregate(quotas, start, draw, lambda acc: acc["taken"])


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """source, shard, first, last: the draws [first, last) of a source that a shard takes.

    ``quotas`` has one row per source (source, quota). Shards hold equally many
    blocks, or one more. Each level of the tree is a table of its nodes.
    """
    slot = F.struct(F.col("source").isNull().alias("last"), "source", F.col("quota").alias("quota"))
    level = quotas.agg(F.sort_array(F.collect_list(slot)).alias("slots")).select(
        F.transform("slots", lambda s: s["source"]).alias("sources"),
        F.transform("slots", lambda s: s["quota"]).alias("quotas"),
        F.lit(0).cast("long").alias("first_shard"),
        F.lit(shards).cast("long").alias("shards"),
        F.lit(1).cast("long").alias("node"),
    )
    for _ in range((shards - 1).bit_length()):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        half = F.floor(F.col("shards") / 2).cast("long")
        whole = level.withColumn("half", half).withColumn(
            "blocks_left", F.floor(total * F.col("half") / F.col("shards")).cast("long")
        )
        drawn = materialize(
            whole.withColumn("left", _left_quotas(F.col("quotas"), F.col("blocks_left"), F.col("node"), seed)),
            "splits",
        )
        right = F.zip_with("quotas", "left", lambda q, t: q - t)
        child = lambda q, first, n, node: F.struct(
            q.alias("quotas"), first.alias("first_shard"), n.alias("shards"), node.alias("node")
        )
        level = drawn.select(
            "sources",
            F.explode(
                F.when(F.col("shards") == 1, F.array(child(F.col("quotas"), F.col("first_shard"), F.col("shards"), F.col("node"))))
                .otherwise(
                    F.array(
                        child(F.col("left"), F.col("first_shard"), F.col("half"), F.col("node") * 2),
                        child(right, F.col("first_shard") + F.col("half"), F.col("shards") - F.col("half"), F.col("node") * 2 + 1),
                    )
                )
            ).alias("c"),
        ).select("sources", "c.*")
    leaves = level.select(
        F.col("first_shard").alias("shard"), F.explode(F.arrays_zip("sources", "quotas")).alias("s")
    ).select("shard", F.col("s.sources").alias("source"), F.col("s.quotas").alias("blocks"))
    # One row per shard and source here.
    before = Window.partitionBy("source").orderBy("shard")
    return leaves.select(
        "source",
        "shard",
        (F.sum("blocks").over(before) - F.col("blocks")).alias("first"),
        F.sum("blocks").over(before).alias("last"),
    ).filter("first < last")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _blocks(rows: DataFrame, targets: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Rows with their source's target and their block, both written once."""
    t = targets.withColumnRenamed("source", "_source")
    count = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    return materialize(
        rows.join(t, _same(F.col("source"), F.col("_source")))
        .drop("_source")
        .withColumn("blocks", count)
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "place"), F.col("blocks"))),
        "placed",
    )


def _starts(placed: DataFrame) -> DataFrame:
    """source, block, words, start: words of a source before each block.

    The running sum goes by groups of blocks and then within a group.
    """
    sums = materialize(
        placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                                              F.first("source_size").alias("source_size"), F.first("blocks").alias("blocks"))
        .withColumn("part", F.floor(F.col("block") / _GROUP)),
        "blocks",
    )
    parts = sums.groupBy("source", "part").agg(F.sum("words").alias("part_words"))
    over = Window.partitionBy("source").orderBy("part")
    parts = parts.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"),
        (F.sum("part_words").over(over) - F.col("part_words")).alias("part_start"),
    )
    within = Window.partitionBy("source", "part").orderBy("block")
    return sums.join(parts, _same(F.col("source"), F.col("_source")) & (F.col("part") == F.col("_part"))).select(
        "source", "block", "words", "target", "source_size", "blocks",
        (F.col("part_start") + F.sum("words").over(within) - F.col("words")).alias("start"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    block_words: int = BLOCK_WORDS,
    shards: int | None = None,
    seed: int = SEED,
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their sources' figures, and the copies of them that the mix takes.

    Rows: doc_id, row_no, source, size, source_size, target. Copies: row_no,
    epoch, words (taken of that copy, its first ones), shard, position (order
    in the shard). The words of a source's copies add up to its target rounded
    down; no row is taken over ``most`` times. A null text has no words and is
    never taken; null is a source of its own; repeated rows are rows of their
    own; an empty table gives two empty results. Blocks, draws and positions
    depend only on the rows' ids, sources and texts and on ``seed``, so reruns
    agree however the input is cut; of equal rows any one may be taken more
    often. There is a shard per ``SHARD_BLOCKS`` blocks, and ``SHARDS`` at least.
    """
    rows = sized_rows(docs, id_col, source_col, text_col, row_col)
    targets = materialize(source_targets(rows, weights, share, most), "targets")
    placed = _blocks(rows, targets, block_words, seed)
    wanted = F.floor(F.col("target")).cast("long")
    # Words of the block that each epoch takes: the line of all epochs is cut at the target.
    epochs = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("epoch")
    draws = (
        _starts(placed)
        .select("*", epochs)
        .withColumn("take", F.least(F.col("words"), wanted - (F.col("epoch") * F.col("source_size") + F.col("start"))))
        .filter("take > 0")
        .withColumn("draw", F.col("epoch") * F.col("blocks") + F.col("block"))
    )
    draws = materialize(draws.select("source", "block", "epoch", "take", "draw"), "draws")
    quotas = materialize(draws.groupBy("source").agg((F.max("draw") + 1).alias("quota")), "quotas")
    if shards is None:
        shards = max(SHARDS, -(-(quotas.agg(F.sum("quota")).first()[0] or 0) // SHARD_BLOCKS))
    shares = materialize(split_quotas(quotas, shards, seed), "shares").withColumnRenamed("source", "_source")
    numbered = shares.select("_source", "shard", F.explode(F.sequence("first", F.col("last") - 1)).alias("_draw"))
    dealt = draws.join(
        numbered, _same(F.col("source"), F.col("_source")) & (F.col("draw") == F.col("_draw"))
    ).select("_source", F.col("block").alias("_block"), "epoch", "take", "shard")
    # Within a block the rows stand in a permuted order of their own.
    within = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed + 1), "place"), "place")
    lined = placed.select(
        "row_no", "place", "source", "block", "size", (F.sum("size").over(within) - F.col("size")).alias("before")
    )
    copies = (
        lined.join(dealt, _same(F.col("source"), F.col("_source")) & (F.col("block") == F.col("_block")))
        .withColumn("words", F.least(F.col("size"), F.col("take") - F.col("before")))
        .filter("words > 0")
        .select("row_no", "place", "epoch", "words", "shard")
    )
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), "place", "epoch"), "place", "epoch")
    positioned = copies.withColumn("position", F.row_number().over(shuffled).cast("long")).drop("place")
    return placed.select("doc_id", "row_no", "source", "size", "source_size", "target"), positioned


def taken_per_row(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """One row per row of the input with the words that the mix takes of it."""
    sums = copies.groupBy("row_no").agg(
        F.sum("words").alias("taken"), F.min(F.struct("shard", "position")).alias("first"), F.count("*").alias("copies")
    )
    return rows.join(sums, "row_no", "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
        F.col("first.shard").alias("first_shard"),
        F.col("first.position").alias("first_position"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` once per copy that the mix takes, in the order of its
    shards and of the positions in them: partitions follow each other in it.

    A copy that is taken in part has the text up to its last word taken. Other
    columns of ``docs``, whatever their names, are kept as they are.
    """
    row, words, size, shard, position = (_free(docs, n) for n in ("_row", "_words", "_size", "_shard", "_position"))
    kept = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mixed-input")
    rows, copies = mix(kept.select(id_col, source_col, text_col, row), id_col, source_col, text_col, row_col=row, **options)
    taken = copies.join(rows.select("row_no", "size"), "row_no").select(
        F.col("row_no").alias(row), F.col("words").alias(words), F.col("size").alias(size),
        F.col("shard").alias(shard), F.col("position").alias(position),
    )
    joined = kept.join(taken, row)
    whole = F.col(text_col)
    # The last entry of the split is what follows the words taken.
    ahead = F.ltrim(whole, F.lit(BLANKS))
    rest = F.element_at(F.split(ahead, BLANK_RUN, (F.col(words) + 1).cast("int")), -1)
    part = F.rtrim(F.substring(ahead, F.lit(1), F.length(ahead) - F.length(rest)), F.lit(BLANKS))
    text = F.when(F.col(words) < F.col(size), part).otherwise(whole)
    ordered = joined.repartitionByRange(shard, position).sortWithinPartitions(shard, position)
    return ordered.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name
