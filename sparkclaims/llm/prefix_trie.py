"""Trie of conversation prefixes from composable fingerprints.

A sequence of turns has the fingerprint sum(H(turn_i) * B^i) modulo a few
primes, with its length: sequences form a monoid, in which concatenation is
one multiplication and one addition, and a known beginning can be taken off
again. A rebuilt conversation, the head of a base conversation followed by an
own suffix, therefore gets the fingerprints of all its prefixes from the
prefix fingerprints of the stored conversations: no rebuilt text is made.

Prefixes with one fingerprint are one node. A node refers to the stored turn
that ends each of its prefixes; equal references (content digests) there, with
equal fingerprints, make the shorter prefixes' fingerprints equal too, so the
groups are verified turn by turn. Should a group fail, another base is drawn.

All figures of subtrees are sums over the members of a node: a conversation
represents its nodes from the depth on where it is the smallest member, and
the rest of its turns is what the trie saves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.llm.words import words
from sparkclaims.operators.joins import join_null_safe, skew_join
from sparkclaims.operators.positions import BLOCK, INDEX, ordered_blocks
from sparkclaims.storage import materialize

#: Primes below 2^31, so that products fit a long.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
#: Longest head, and ids that are hashed as one text.
MOST_HEAD, RUN_IDS = 3, 4_096
#: Bits of a conversation's length.
LENGTH_BITS = 40
_PRINTS = [f"f{k}" for k in range(len(PRIMES))]


def _base(k: int, seed: int) -> int:
    """The multiplier of prime ``k``: drawn from the seed, neither 0 nor 1."""
    drawn = hashlib.sha256(f"{seed}:{k}".encode()).digest()
    return 2 + int.from_bytes(drawn[:8], "big") % (PRIMES[k] - 2)


def _power(k: int, seed: int, exponent: Column) -> Column:
    """The base to the power of ``exponent`` (0 or more) modulo prime ``k``, by squares."""
    prime, base = PRIMES[k], _base(k, seed)
    squares = [pow(base, 1 << bit, prime) for bit in range(LENGTH_BITS)]
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(s).cast("long").alias("by")) for b, s in enumerate(squares)])
    used = F.filter(steps, lambda s: s["bit"].bitwiseAND(exponent.cast("long")) != 0)
    return F.aggregate(used, F.lit(1).cast("long"), lambda done, s: done * s["by"] % prime)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, ref (content digest of role and text) and words of each turn, written once."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return materialize(
        conversations.filter("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn",
            F.unhex(F.sha2(content.cast("binary"), 256)).alias("ref"),
            F.size(words(text)).cast("long").alias("words"),
        ),
        "turns",
    )


def prefixes(ordered: DataFrame, seed: int) -> DataFrame:
    """conv_id, at (1-based), ref, words, upto (words up to here) and the fingerprints f0.. of
    each prefix of the stored conversations.

    ``ordered`` has the turns in blocks. Each block makes the fingerprints of
    its own run of a conversation; what came before in other blocks is put in
    front of them by the monoid's product, one row per block and conversation.
    """
    local = Window.partitionBy(BLOCK, "conv_id").orderBy(INDEX).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    inside = ordered.withColumn("_at", F.count("*").over(local)).withColumn("_upto", F.sum("words").over(local))
    for k, prime in enumerate(PRIMES):
        value = F.pmod(F.xxhash64("ref", F.lit(seed * len(PRIMES) + k)), F.lit(prime - 1)) + 1
        inside = inside.withColumn(f"_t{k}", value * _power(k, seed, F.col("_at")) % prime)
    inside = inside.withColumns({f"_f{k}": F.sum(f"_t{k}").over(local) % prime for k, prime in enumerate(PRIMES)})
    inside = materialize(inside.drop(*[f"_t{k}" for k in range(len(PRIMES))]), "runs")
    last = F.struct("_at", "_upto", *[f"_f{k}" for k in range(len(PRIMES))])
    # One row per block and conversation.
    cut = inside.groupBy(BLOCK, "conv_id").agg(F.max(last).alias("last"))
    placed = cut.select(
        BLOCK, "conv_id", "last", F.sum("last._at").over(whole).alias("_before"), F.sum("last._upto").over(whole).alias("_before_words")
    )
    shifted = {
        f"_p{k}": F.sum(F.col(f"last._f{k}") * _power(k, seed, F.coalesce("_before", F.lit(0))) % prime).over(whole) % prime
        for k, prime in enumerate(PRIMES)
    }
    carried = placed.withColumns(shifted).filter("_before > 0").drop("last")
    joined = join_null_safe(inside, materialize(carried, "carried"), [BLOCK, "conv_id"], "left")
    zero = F.lit(0).cast("long")
    before = F.coalesce("_before", zero)
    return joined.select(
        "conv_id", (F.col("_at") + before).alias("at"), "ref", "words",
        (F.col("_upto") + F.coalesce("_before_words", zero)).alias("upto"),
        *[
            F.when(before == 0, F.col(f"_f{k}"))
            .otherwise((F.col(f"_f{k}") * _power(k, seed, before) + F.coalesce(f"_p{k}", zero)) % prime)
            .alias(f"f{k}")
            for k, prime in enumerate(PRIMES)
        ],
    )


_EMPTY = "named_struct('at', 0L, 'ref', X'', 'words', 0L, 'upto', 0L, " + ", ".join(f"'{f}', 0L" for f in _PRINTS) + ")"


def rebuilt(own: DataFrame, head_turns: Column, base_of: Column) -> DataFrame:
    """One row per conversation: h (turns of the base's head that are wished), its own turns and
    words, ``before`` (its own prefix that the head replaces) and ``head`` (the prefixes of the base's head).

    A conversation's first ``MOST_HEAD`` prefixes are kept in its row; a base
    serves few conversations, so the join by base has no hot key.
    """
    prefix = F.struct("at", "ref", "words", "upto", *_PRINTS)
    conversations = materialize(
        own.groupBy("conv_id").agg(
            F.max("at").alias("n"), F.max("upto").alias("n_words"),
            F.array_sort(F.collect_list(F.when(F.col("at") <= MOST_HEAD, prefix))).alias("first"),
        ),
        "conversations",
    )
    bases = conversations.select(F.col("conv_id").alias("_base"), F.col("first").alias("_first"))
    asked = conversations.withColumn("h", head_turns.cast("long")).withColumn("_of", base_of)
    found = asked.join(bases, F.col("_of") == F.col("_base"), "left")
    root = F.array(F.expr(_EMPTY))
    head = F.slice(F.coalesce("_first", F.array().cast(found.schema["_first"].dataType)), F.lit(1), F.col("h").cast("int"))
    whole = found.select(
        "conv_id", "h", "n", "n_words",
        F.try_element_at(F.concat(root, "first"), (F.least("h", "n") + 1).cast("int")).alias("before"),
        F.concat(root, head).alias("head"),
    )
    length = F.size("head") - 1 + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return materialize(whole.withColumn("length", length.cast("long")), "rebuilt")


def rebuilt_prefixes(own: DataFrame, conversations: DataFrame, head_turns: Column, seed: int) -> DataFrame:
    """conv_id, depth, length, ref, words, upto and fingerprint of every prefix of every rebuilt
    conversation, from the root (depth 0) on."""
    entry = F.col("entry")
    heads = conversations.select("conv_id", "length", F.posexplode("head").alias("depth", "entry")).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "length", entry["ref"].alias("ref"), entry["words"].alias("words"),
        entry["upto"].alias("upto"), *[entry[f].alias(f) for f in _PRINTS],
    )
    rest = own.filter(F.col("at") > head_turns)
    frequencies = conversations.select("conv_id", F.col("n").alias("_rows"))
    info = conversations.select("conv_id", "length", "h", "before", F.element_at("head", -1).alias("_last"), (F.size("head") - 1).alias("_head"))
    joined = skew_join(rest, info, ["conv_id"], "inner", frequencies=lambda: frequencies)
    lost = (F.col("h") - F.col("_head")).cast("int")

    def composed(k: int) -> Column:
        """Base head, then own suffix: its own beginning is taken off and the rest moved to its place."""
        prime = PRIMES[k]
        back = [F.lit(pow(_base(k, seed), -turns_lost, prime)).cast("long") for turns_lost in range(MOST_HEAD + 1)]
        suffix = F.pmod(F.col(f"f{k}") - F.col(f"before.f{k}"), F.lit(prime))
        return (F.col(f"_last.f{k}") + suffix * F.element_at(F.array(*back), lost + 1)) % prime

    tails = joined.select(
        "conv_id", (F.col("at") - lost).alias("depth"), "length", "ref", "words",
        (F.col("_last.upto") + F.col("upto") - F.col("before.upto")).alias("upto"),
        *[composed(k).alias(f"f{k}") for k in range(len(PRIMES))],
    )
    return materialize(heads.unionByName(tails), "prefixes")


def _groups(rows: DataFrame) -> DataFrame:
    """The nodes: fingerprint, depth, smallest member, members, longest member, and whether the references agree."""
    return materialize(
        rows.groupBy("depth", *_PRINTS).agg(
            F.min("conv_id").alias("rep"), F.count("*").alias("_rows"), F.max("length").alias("longest"),
            (F.min("ref") == F.max("ref")).alias("sound"),
        ),
        "nodes",
    )


def _texts_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts joined by commas; a node's rows come one after the other."""
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for rep, depth, text in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "text")), strict=True):
            if (rep, depth) == key:
                state.update(b"," + text.encode())
            else:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (rep, depth), hashlib.sha256(text.encode())
        yield _hashes(done)
    if state is not None:
        yield _hashes([(*key, state.hexdigest())])


def _hashes(done: list[tuple]) -> pa.RecordBatch:
    kinds = {"rep": pa.int64(), "depth": pa.int64(), "ends": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds.values())], names=list(kinds))


def end_hashes(ends: DataFrame) -> DataFrame:
    """rep, depth and ends: the hash of the ascending ids joined by commas, of ``ends`` (conv_id, rep, depth).

    Ids are joined in runs of near ids first, at most ``RUN_IDS`` each, so a
    hot node is one stream of a few long texts; a hash cannot be split further.
    """
    run = F.floor(F.col("conv_id") / RUN_IDS)
    texts = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    runs = ends.groupBy("rep", "depth", run.alias("run")).agg(F.array_join(texts, ",").alias("text"))
    ordered = runs.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "run")
    return ordered.select("rep", "depth", "text").mapInArrow(_texts_hashed, "rep long, depth long, ends string")


def trie(conversations: DataFrame, head_turns: Column, base_of: Column, seed: int = 0) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``conversations`` has conv_id, turn, role and text. ``head_turns`` (0 to 3)
    and ``base_of`` are expressions of conv_id: the head's turns and the
    conversation they come from. A null role or text is empty, a null turn
    comes first, and equal turn numbers follow their content digest, so
    repeated rows are repeated turns. Rows without conv_id belong to no
    conversation and are left out. Other columns are not read. Without any
    conversation there is no node. A long conversation is spread over blocks,
    and a hot prefix is summed per task before it is shuffled.
    """
    ordered = ordered_blocks(turns(conversations), ["conv_id", "turn", "ref"])
    while True:
        own = materialize(prefixes(ordered, seed), "own-prefixes")
        rows = rebuilt_prefixes(own, rebuilt(own, head_turns, base_of), head_turns, seed)
        nodes = _groups(rows)
        if not nodes.filter(~F.col("sound")).limit(1).count():
            break
        seed += 1
    members = materialize(
        skew_join(
            rows.drop("ref"), nodes.select("depth", *_PRINTS, "rep", "longest"), ["depth", *_PRINTS], "inner",
            frequencies=lambda: nodes.select("depth", *_PRINTS, "_rows"),
        ).select("conv_id", "depth", "length", "words", "upto", "rep", "longest"),
        "members",
    )
    own_node, at_end = F.col("rep") == F.col("conv_id"), F.col("depth") == F.col("length")
    shared = F.when(~own_node, F.struct("depth", "rep", "upto"))
    zero = F.lit(0).cast("long")
    branches = materialize(
        members.groupBy("conv_id").agg(
            F.max(shared).alias("_shared"), F.count("*").alias("_rows"),
            F.max(F.when(at_end, F.struct("rep", "depth", (own_node & (F.col("longest") == F.col("depth"))).alias("leaf")))).alias("_end"),
        ).select(
            "conv_id", "_rows", F.coalesce(F.col("_shared.depth") + 1, zero).alias("branch"), F.col("_shared.rep").alias("above"),
            F.coalesce("_shared.upto", zero).alias("shared_words"), F.col("_end.leaf").alias("leaf"),
            F.col("_end.rep").alias("end_rep"), F.col("_end.depth").alias("end_depth"),
        ),
        "branches",
    )
    facts = branches.select("conv_id", "branch", "above", "shared_words", "leaf")
    frequencies = branches.select("conv_id", "_rows")
    joined = skew_join(members, facts, ["conv_id"], "inner", frequencies=lambda: frequencies)
    child = (F.col("length") > F.col("depth")) & (F.col("branch") <= F.col("depth") + 1)
    saved = F.when(F.col("branch") > F.col("depth"), F.col("shared_words") - F.col("upto") + F.col("words")).otherwise(zero)
    parent = F.when(own_node & (F.col("depth") > 0), F.when(F.col("branch") == F.col("depth"), F.col("above")).otherwise(F.col("rep")))
    summed = joined.groupBy("rep", "depth").agg(
        F.max(parent).alias("parent_conv_id"), F.count("*").alias("n_convs"), F.sum(child.cast("long")).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
    )
    ends = end_hashes(branches.select("conv_id", F.col("end_rep").alias("rep"), F.col("end_depth").alias("depth")))
    return summed.join(ends, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
