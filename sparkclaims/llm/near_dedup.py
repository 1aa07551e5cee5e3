"""Near copies by MinHash with tensored banding.

Two small collections of bands, A and B, of ``GROUPS`` bands each are computed
per document; table (i, j) has the pair of band A_i and band B_j as its key.
``GROUPS ** 2`` tables so cost the minhashes of ``2 * GROUPS`` bands, the
square root of what tables of their own would take. Two documents meet in a
table exactly if they share a band of A and a band of B: at a similarity s and
``ROWS`` minhashes per band they miss with at most
2 * (1 - s ** ROWS) ** GROUPS, 2.5e-4 at s = 0.85 and 1e-5 at 0.9.

Documents that met are candidates. Candidate clusters, the components of the
"met" graph, are then verified on the full shingle sets:

- In a cluster of more than ``TILE`` documents, leaders are drawn: of some 64
  of its documents, compared with each other, those that link most. Every
  member is compared with the leaders of its cluster, one row per member.
- What links with no leader is then tested by its prefix: in the order "shingles
  that no leader has first", two sets at the bound share one of their first
  n - ceil(bound * n) + 1 shingles. A member whose prefix nobody shares has no
  link (exact). That is tested again only after leaders that link a share of the
  members. Leaders are drawn again from the rest while that resolves it.
- What stays is cut in tiles of ``TILE`` documents by size of set and by what
  the leaders linked already. Each pair of tiles whose sizes allow a link, and
  which is not linked already, is one group: the overlaps of its documents are
  counted exactly, and it returns links that join what it found linked, at most
  one per document. No list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.llm import hashing
from sparkclaims.llm.arrow import slices
from sparkclaims.llm.components import components
from sparkclaims.llm.words import BLANK_RUN, bind
from sparkclaims.storage import materialize

SHINGLE = 5
PERCENT = 85
GROUPS = 7
ROWS = 2
TILE = 128
#: Members compared to choose leaders (about), leaders of a round, and the share of open members that a round must resolve to be followed by one more.
DRAWN, LEADERS, RESOLVED = 64, 4, 0.125
# Columns of one block of the overlap counts.
_BLOCK = 4096


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    values = hashing.mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return values[:count] | np.uint64(1), values[count:]


def _sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, where each begins, and a 128-bit digest of each set."""
    shingles, starts = hashing.shingles_of(hashing.words_of(texts), size)
    parts = [np.unique(shingles[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    counts = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(counts)))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    # Sums of mixed members do not depend on their order.
    sums = np.zeros((len(parts), 2), np.uint64)
    some = counts > 0
    for k, salt in enumerate(_seeds(1)):
        mixed = hashing.mix(flat ^ salt)
        if some.any():
            sums[some, k] = np.add.reduceat(mixed, starts[:-1][some])
    return flat, starts, sums


def _digests(sums: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in sums], pa.binary())


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, groups: int, rows: int) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, digest of the set, bands_a, bands_b of every row."""
    count = 2 * groups * rows

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, terms = _seeds(count)
        for part, texts in slices(batches, "text"):
            flat, starts, sums = _sets(texts, size)
            counts = np.diff(starts)
            some = counts > 0
            least = np.zeros((len(texts), count), np.uint64)
            for h in range(count):
                if some.any():
                    values = (flat ^ terms[h]) * factors[h]
                    least[some, h] = np.minimum.reduceat(values ^ (values >> np.uint64(32)), starts[:-1][some])
            bands = np.zeros((len(texts), 2 * groups), np.uint64)
            for r in range(rows):
                bands = hashing.mix(bands * np.uint64(31) + least[:, r::rows])
            lists = [
                pa.FixedSizeListArray.from_arrays(
                    pa.array(np.ascontiguousarray(side).view(np.int64).ravel()), groups
                ).cast(pa.list_(pa.int64()))
                for side in (bands[:, :groups], bands[:, groups:])
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts, pa.int64()), _digests(sums), *lists],
                ["doc_id", "text_key", "n_shingles", "digest", "bands_a", "bands_b"],
            )

    return _keyed(docs, id_col, text_col).mapInArrow(
        sketch,
        "doc_id long, text_key long, n_shingles long, digest binary, bands_a array<long>, bands_b array<long>",
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key and text: rows that repeat an id, or have none, are told apart by their texts."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _tables(groups: int) -> Column:
    """The keys of all tables: every band of A with every band of B."""
    return F.flatten(
        F.transform(
            "bands_a",
            lambda a, i: F.transform("bands_b", lambda b, j: F.xxhash64(a, b, i * groups + j)),
        )
    )


def _met(nodes: DataFrame, groups: int) -> DataFrame:
    """Links a, b that join the documents which met in a table.

    A document meets the smallest one of each of its tables. It is linked to
    the smallest of those, and so are they, which keeps what is joined: about
    one link per document, since few documents are the smallest of a table.
    """
    keyed = nodes.select(F.col("node").alias("a"), F.explode(_tables(groups)).alias("key"))
    first = keyed.groupBy("key").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(first, "key").filter("a <> b").select("a", "b").distinct()
    # At most as many rows per window as there are tables.
    least = materialize(met.withColumn("least", F.min("b").over(Window.partitionBy("a"))), "met")
    own = least.select("a", F.col("least").alias("b"))
    others = least.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return own.union(others).distinct()


def _with_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """node, cluster and the set of shingles of each member, from the texts of one row each."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part, texts in slices(batches, "text"):
            # Rows that repeat an id and a text follow each other; one of them will do.
            ids = part.column(1).to_pylist()
            fresh = [node != before for node, before in zip(ids, [last, *ids])]
            last = ids[-1] if ids else last
            part, texts = part.filter(pa.array(fresh, pa.bool_())), [t for t, f in zip(texts, fresh) if f]
            flat, starts, sums = _sets(texts, size)
            digests = _digests(sums)
            same = [a == b for a, b in zip(digests.to_pylist(), part.column(0).to_pylist())]
            lists = pa.ListArray.from_arrays(
                pa.array(starts, pa.int32()), pa.array(flat.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), lists], ["node", "cluster", "shingles"]
            ).filter(pa.array(same, pa.bool_()))

    rows = _keyed(docs, id_col, text_col)
    # The members grow with the input, so they are never broadcast.
    found = rows.join(
        members.hint("merge"), (rows.text_key == members.some_key) & rows.doc_id.eqNullSafe(members.some_id)
    ).select("digest", "node", "cluster", "text")
    return found.mapInArrow(collect, "node long, cluster long, shingles array<long>")


def _leaders(group: pd.DataFrame, percent: int, most: int) -> pd.DataFrame:
    """Of a few members of one cluster, those that link most of what the ones before them do not."""
    group = group.sort_values("node")
    sets = [np.asarray(s, dtype=np.int64) for s in group["shingles"]]
    linked = _linked(sets, percent)
    np.fill_diagonal(linked, True)
    chosen, free = [], np.ones(len(sets), dtype=bool)
    while len(chosen) < most and free.any():
        gain = (linked & free).sum(axis=1)
        best = int(gain.argmax())
        # The first leader also tells the cluster's common shingles; a further one must link something.
        if chosen and gain[best] < 2:
            break
        chosen.append(best)
        free &= ~linked[best]
    return group.iloc[chosen][["cluster", "node", "shingles"]].rename(columns={"node": "leader"})


def _compared(sets: DataFrame, alive: DataFrame, opened: DataFrame, percent: int, turn: int) -> DataFrame:
    """cluster, node, n, near (leaders linked with it) and prefix of the members of the ``opened`` clusters.

    ``opened`` has the number of open members of each cluster.
    """
    drawn = (
        alive.filter("open")
        .join(opened, "cluster")
        .filter(F.pmod(F.xxhash64("node", F.lit(turn)), "n_open") < DRAWN)
        .select("node")
    )
    leads = materialize(
        sets.join(drawn, "node")
        .select("cluster", "node", "shingles")
        .groupBy("cluster")
        .applyInPandas(lambda g: _leaders(g, percent, LEADERS), "cluster long, leader long, shingles array<long>")
        .groupBy("cluster")
        .agg(F.collect_list(F.struct("leader", "shingles")).alias("leads")),
        "leaders",
    )
    n = F.size("shingles")

    def links(lead: Column) -> Column:
        return bind(
            F.size(F.array_intersect("shingles", lead["shingles"])),
            lambda shared: 100 * shared >= percent * (n + F.size(lead["shingles"]) - shared),
        )

    known = F.flatten(F.transform("leads", lambda lead: lead["shingles"]))
    ordered = F.concat(F.array_except("shingles", known), F.array_intersect("shingles", known))
    length = (n - F.ceil(n * percent / 100) + 1).cast("int")
    near = F.transform(F.filter("leads", links), lambda lead: lead["leader"])
    return materialize(
        sets.select("node", "shingles")
        .join(alive, "node")
        .join(leads, "cluster")
        .select("cluster", "node", "open", n.alias("n"), near.alias("near"), F.slice(ordered, 1, length).alias("prefix")),
        "compared",
    )


def _alone(compared: DataFrame) -> DataFrame:
    """node of the members whose prefix no other member of the cluster shares a shingle of."""
    return (
        compared.select("cluster", "node", F.size("prefix").alias("length"), F.explode("prefix").alias("shingle"))
        .groupBy("cluster", "shingle")
        .agg(F.min(F.struct("node", "length")).alias("first"), F.max("node").alias("last"))
        .filter(F.col("first.node") == F.col("last"))
        .groupBy(F.col("last").alias("node"))
        .agg(F.count("*").alias("own"), F.first("first.length").alias("length"))
        .filter("own = length")
        .select("node")
    )


def _resolved(sets: DataFrame, percent: int, tile: int) -> tuple[DataFrame, DataFrame | None]:
    """cluster, node, n and label of the members still to compare; and the links found by leaders.

    Members with one label are linked already; a null label is none. All
    members of clusters within one tile are there, without label.
    """
    sized = sets.select("cluster", "node", F.size("shingles").alias("n"))
    # One row per large cluster, written so that its size is known before it is joined.
    large = materialize(
        sized.groupBy("cluster").agg(F.count("*").alias("n_open")).filter(F.col("n_open") > tile), "large"
    )
    small = sized.join(large, "cluster", "left_anti").withColumn("label", F.lit(None).cast("long"))
    total = large.agg(F.sum("n_open")).first()[0]
    if not total:
        return small, None
    alive = materialize(
        sized.join(large.select("cluster"), "cluster", "left_semi").withColumn("open", F.lit(True)), "alive"
    )
    opened, settled, links, turn = large, None, None, 0
    while total:
        compared = _compared(sets, alive.select("cluster", "node", "open"), opened, percent, turn)
        found = materialize(
            compared.select("node", F.explode("near").alias("b"))
            .filter("node <> b")
            .select(F.col("node").alias("a"), "b"),
            "led",
        )
        links = found if links is None else links.union(found)
        linked = F.size("near") > 0
        rest = compared
        # After leaders that link few more, the prefixes would tell much the same again.
        if not turn or compared.filter(F.col("open") & linked).count() >= RESOLVED * total:
            rest = compared.join(_alone(compared).withColumn("alone", F.lit(True)), "node", "left").filter(
                linked | ~F.col("open") | F.col("alone").isNull()
            )
        after = materialize(
            rest.select("cluster", "node", "n", (F.col("open") & ~linked).alias("open")), "alive"
        )
        n_open = after.groupBy("cluster").agg(F.sum(F.col("open").cast("long")).alias("n_open"))
        more = materialize(n_open.filter(F.col("n_open") > tile), "opened")
        before, total = total, more.agg(F.sum("n_open")).first()[0] or 0
        if total > (1 - RESOLVED) * before:
            total = 0
        # Clusters that need no leaders any more are left as they are.
        done = after if not total else after.join(more.select("cluster"), "cluster", "left_anti")
        settled = done if settled is None else settled.union(done)
        alive = after.join(more.select("cluster"), "cluster", "left_semi")
        opened, turn = more, turn + 1
    labels = components(links).withColumnRenamed("component", "label")
    return small.unionByName(settled.drop("open").join(labels, "node", "left")), links


def _tiled(sized: DataFrame, percent: int, tile: int) -> DataFrame:
    """Members with the pairs of tiles (p <= q) in which they are compared.

    The tiles of a cluster are ranges of set sizes under one label, split
    evenly at random; a pair of tiles is left out when no sizes of it can link
    or its label is the same.
    """
    # Sizes within 2 % are one step; a cluster's members of a step are spread over tiles.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.02))).cast("int")
    stepped = sized.withColumn("step", step).withColumn("label", F.coalesce("label", F.lit(-1)))
    counts = stepped.groupBy("cluster", "step", "label").agg(F.count("*").alias("m"))
    reach = F.lit(int(np.ceil(np.log(100 / percent) / np.log(1.02))) + 1)
    tiles = F.ceil(F.col("m") / tile).cast("int").alias("tiles")
    # Labels are at most the leaders of a cluster, steps at most some hundreds; written so that its size is known.
    spread = materialize(
        counts.groupBy("cluster").agg(
            F.sum("m").alias("members"), F.sort_array(F.collect_list(F.struct("step", "label", tiles))).alias("steps")
        ).filter("members > 1"),
        "spread",
    )
    joined = stepped.join(spread, "cluster")
    mine = F.filter("steps", lambda s: (s["step"] == F.col("step")) & (s["label"] == F.col("label")))[0]["tiles"]
    placed = joined.withColumn("part", F.pmod(F.xxhash64("node"), mine).cast("int"))
    # A cluster of one tile's size is one group.
    me = F.struct("step", "label", "part")
    others = F.flatten(
        F.transform(
            F.filter(
                "steps",
                lambda s: (F.abs(s["step"] - F.col("step")) <= reach)
                & ((s["label"] != F.col("label")) | (F.col("label") == -1)),
            ),
            lambda s: F.transform(
                F.sequence(F.lit(0), s["tiles"] - 1),
                lambda k: F.struct(s["step"].alias("step"), s["label"].alias("label"), k.alias("part")),
            ),
        )
    )
    pairs = F.when(
        F.col("members") <= tile, F.array(F.struct(F.lit("").alias("p"), F.lit("").alias("q")))
    ).otherwise(
        F.transform(
            others,
            lambda o: F.struct(
                F.to_json(F.least(me, o)).alias("p"), F.to_json(F.greatest(me, o)).alias("q")
            ),
        )
    )
    return placed.select("cluster", "node", F.explode(pairs).alias("tiles"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a group, exactly."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.cumsum(np.diff(column[order], prepend=-1) > 0) - 1 if len(order) else column
    total = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _BLOCK):
        a, b = np.searchsorted(column, (low, low + _BLOCK))
        block = np.zeros((len(sets), _BLOCK), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        total += np.rint(block @ block.T).astype(np.int64)
    return total


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a group are linked."""
    sizes = np.array([len(s) for s in sets])
    shared = _overlaps(sets)
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(linked, False)
    return linked


def _links(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join the documents of a group as all its links would."""
    group = group.drop_duplicates("node")
    nodes = group["node"].to_numpy()
    linked = _linked([np.asarray(s, dtype=np.int64) for s in group["shingles"]], percent)
    seen = np.zeros(len(nodes), dtype=bool)
    a, b = [], []
    for root in range(len(nodes)):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            at = front.pop()
            fresh = np.flatnonzero(linked[at] & ~seen)
            seen[fresh] = True
            a.extend(nodes[fresh])
            b.extend([nodes[root]] * len(fresh))
            front.extend(fresh)
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    groups: int = GROUPS,
    rows: int = ROWS,
    tile: int = TILE,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    A document's set holds its distinct runs of ``size`` lower-cased words; a
    shorter text is one run, and a text without words, or null, has the empty
    set and is linked with nothing. Sets are compared by 64-bit shingle hashes.
    Documents are linked when 100 * intersection >= percent * union; the
    component is the smallest id reachable. Equal sets count as one document
    until the end. A null id is kept as it is, and is the component only if all
    ids of it are null. Repeated rows are linked; ``kept`` compares ids, so
    rows that repeat the smallest id are all kept. Other columns are not
    looked at, and an empty table gives an empty result.
    """
    return _grouped(docs, id_col, text_col, size, percent, groups, rows, tile).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, groups: int, rows: int, tile: int
) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and component (null for empty sets) of every row."""
    rows_ = materialize(sketches(docs, id_col, text_col, size, groups, rows), "sketches")
    some = rows_.filter("n_shingles > 0")
    nodes = materialize(
        some.groupBy("digest")
        .agg(
            F.max(F.struct("doc_id", "text_key")).alias("some"),
            F.min("doc_id").alias("least_id"),
            F.first("bands_a").alias("bands_a"),
            F.first("bands_b").alias("bands_b"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"),
            F.col("some.doc_id").alias("some_id"),
            F.col("some.text_key").alias("some_key"),
            "*",
        )
        .drop("some"),
        "nodes",
    )
    clusters = components(_met(nodes, groups))
    members = materialize(
        nodes.join(clusters, "node").select("digest", "some_id", "some_key", "node", F.col("component").alias("cluster")),
        "members",
    )
    sets = materialize(_with_sets(docs, members, id_col, text_col, size), "sets")
    left, led = _resolved(sets, percent, tile)
    links = (
        sets.drop("cluster")
        .join(_tiled(left, percent, tile), "node")
        .groupBy("cluster", "tiles")
        .applyInPandas(lambda group: _links(group, percent), "a long, b long")
    )
    found = components(links if led is None else links.union(led))
    named = nodes.join(found, "node", "left").select(
        "digest", "least_id", F.coalesce("component", "node").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    names = named.join(least, "component").select("digest", "component", "component_id")
    linked = some.select("doc_id", "text_key", "n_shingles", "digest").join(names, "digest")
    empty = rows_.filter("n_shingles = 0")
    return linked.select("doc_id", "text_key", "n_shingles", "component_id", "component").union(
        empty.select(
            "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long")
        )
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    groups: int = GROUPS,
) -> DataFrame:
    """One row of each component stays: that with the smallest id.

    A null id counts as larger than any; equal ids go by a hash of the text,
    and of rows with one id and one text any one stays. Texts without words
    are in no component: all their rows stay. The columns may have any names,
    and an empty table gives an empty result.
    """
    grouped = materialize(_grouped(docs, id_col, text_col, SHINGLE, percent, groups, ROWS, TILE), "grouped")
    # Ids and hashes only; a large component is combined before the shuffle.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = materialize(
        grouped.filter("component IS NOT NULL")
        .groupBy("component")
        .agg(F.min(order).alias("least"))
        .select(F.col("least.doc_id").alias("kept_id"), F.col("least.text_key").alias("kept_key")),
        "chosen",
    )
    repeated = materialize(
        grouped.filter("component IS NOT NULL")
        .groupBy(F.col("doc_id").alias("again_id"), F.col("text_key").alias("again_key"))
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "repeated",
    )
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_key"), whole.alias("row"))
    this = (F.col("text_key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    again = (F.col("text_key") == F.col("again_key")) & F.col("doc_id").eqNullSafe(F.col("again_id"))
    wordless = F.regexp_replace(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), BLANK_RUN, "") == ""
    kept = rows.filter(~wordless).join(chosen, this, "left_semi")
    once = kept.join(repeated, again, "left_anti")
    # Equal rows collapse within tasks.
    collapsed = kept.join(repeated, again, "left_semi").groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
    return (
        once.select("row.*").unionAll(collapsed.select("row.*")).unionAll(rows.filter(wordless).select("row.*"))
    )
