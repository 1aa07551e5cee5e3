"""Merkle manifest of a dataset whose parents keep the hash states between their children.

Rows are leaves. The leaves of a group (a source) make a tree in order of
their ids, and the roots of the groups make the tree of the dataset. A parent
is the hash of up to ``FAN`` children's digests as hexadecimal text; it keeps
the state of that hash before each child. To learn what the root becomes when
one row changes, the state before it is resumed with its new digest and with
what stands to the right of it, and so on upwards: nothing to the left is
hashed again.

Trees are cut in blocks of ``FAN ** LEVELS`` consecutive leaves, then blocks
of that many block digests, and so on. A block is one row and is hashed in one
task, so a group of any size is spread over all tasks, and a layer above has
that many times fewer rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.llm import sha256
from sparkclaims.operators.joins import join_null_safe, skew_join
from sparkclaims.operators.positions import dense_key, running_sums
from sparkclaims.storage import materialize

#: Children of a parent, and fields of a leaf in their order.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block.
LEVELS = 2
BLOCK = FAN**LEVELS
#: Blocks that are hashed together in a task.
SLICE = 64


@dataclass(frozen=True)
class Manifest:
    """The written tables of a manifest.

    ``layers``: for each layer of the group trees, from the leaves up, one row
    per block with its children, the states before each of them and its digest
    (``top``). ``upper``: the same for the tree over the groups. ``groups``:
    each group's place in that tree, leaves and subroot. ``root`` is None
    without any leaf.
    """

    layers: list[DataFrame]
    upper: list[DataFrame]
    groups: DataFrame
    root: bytes | None


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields; each is ``-`` for null, else its byte count, ``:`` and its text."""
    return F.unhex(F.sha2(F.concat(*[_field(f) for f in fields]).cast("binary"), 256))


def _levels(n: Column) -> Column:
    """Levels of a tree of ``n`` leaves (up to ``FAN`` ** 15)."""
    return reduce(lambda done, k: done + (n > FAN**k).cast("int"), range(15), F.lit(0))


def _blocks(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """One row per block of the nodes (grp, pos, n, levels, digest), children in order.

    A block has at most ``BLOCK`` children, whatever the size of its group.
    """
    row = F.struct("pos", "digest", *payload)
    children = F.transform(F.col("rows"), lambda r: F.hex(r["digest"]))
    return (
        nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"), "n", "levels")
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
        .select(
            "grp", "block", "n", "levels", F.unhex(F.array_join(children, "")).alias("children"),
            *[F.col("rows")[c].alias(c) for c in payload],
        )
    )


def _parents(digests: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States before each child, digests of the parents, and parents per run,
    for runs of ``sizes`` consecutive nodes that each start a parent."""
    slots, counts, owner, parents = places(sizes)
    first = np.flatnonzero(slots == 0)
    fill = counts[first]
    states = sha256.first_states(len(first))
    before = np.empty((len(digests), 8), np.uint32)
    for slot in range(int(fill.max(initial=0))):
        has = np.flatnonzero(fill > slot)
        before[first[has] + slot] = states[has]
        states[has] = sha256.compress(states[has], sha256.hex_blocks(digests[first[has] + slot]))
    return before, sha256.compress(states, sha256.last_blocks(fill)), parents


def places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes in runs of ``sizes``: slot, number of siblings with itself, and
    parent (numbered over all runs); and the parents of each run."""
    ends = np.cumsum(sizes)
    index = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    parents = -(-sizes // FAN)
    starts = np.cumsum(parents) - parents
    slots = index % FAN
    counts = np.minimum(FAN, np.repeat(sizes, sizes) - index + slots)
    return slots, counts, np.repeat(starts, sizes) + index // FAN, parents


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each block the states (of all its levels), its inner nodes and its digest."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            levels = np.array(part.column("levels").to_pylist())
            inside = [sha256.words_of(c) for c in part.column("children").to_pylist()]
            states: list[list[bytes]] = [[] for _ in inside]
            inner: list[list[bytes]] = [[] for _ in inside]
            for level in range(LEVELS):
                live = np.flatnonzero(levels > level)
                if not len(live):
                    break
                sizes = np.array([len(inside[k]) for k in live])
                before, digests, parents = _parents(np.concatenate([inside[k] for k in live]), sizes)
                for k, old, new in zip(
                    live, np.split(before, np.cumsum(sizes)[:-1]), np.split(digests, np.cumsum(parents)[:-1]), strict=True
                ):
                    states[k].append(sha256.bytes_of(old))
                    inner[k].append(sha256.bytes_of(new))
                    inside[k] = new
            added = {
                "states": [b"".join(s) for s in states],
                "inner": [b"".join(s) for s in inner],
                "top": [sha256.bytes_of(i) for i in inside],
            }
            names = [*part.schema.names, *added]
            arrays = [*part.columns, *[pa.array(v, pa.binary()) for v in added.values()]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _climb(nodes: DataFrame, strides: int, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The layers over ``nodes``, each written once; a group ends in the layer that holds its last level."""
    layers = []
    for _ in range(strides):
        blocks = _blocks(nodes, payload)
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in blocks.schema)}, states binary, inner binary, top binary"
        layers.append(materialize(blocks.mapInArrow(_hash_blocks, schema), "merkle"))
        nodes = layers[-1].filter(F.col("levels") > LEVELS).select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"),
            (F.col("levels") - LEVELS).alias("levels"), F.col("top").alias("digest"),
        )
        payload = ()
    return layers


def _rows(sizes: DataFrame) -> DataFrame:
    return sizes.select("grp", F.col("n").alias("_rows"))


def _strides(nodes: DataFrame) -> int:
    deepest = nodes.agg(F.max("levels")).first()[0]
    return max(1, -(-(deepest or 0) // LEVELS))


def _tops(layers: list[DataFrame]) -> DataFrame:
    """grp and top of every group, from the layer in which it ends."""
    ended = [layer.filter(F.col("levels") <= LEVELS).select("grp", "top") for layer in layers]
    return reduce(DataFrame.unionByName, ended)


def build(leaves: DataFrame, payload: Sequence[str] = ()) -> Manifest:
    """The manifest of ``leaves``: grp (string), id, digest (binary of 32 bytes) and payload columns.

    Leaves of a group ascend by id (null first), equal ids by digest and
    payload; groups ascend bytewise (null first). The leaves are sorted and
    numbered by range partitions, so a hot group is no task of its own. No
    leaves give tables without rows.
    """
    placed = running_sums(leaves, ["grp"], ["id", "digest", *payload], {"pos": F.lit(1)}).withColumn("pos", F.col("pos") - 1)
    numbered = materialize(placed, "merkle-leaves")
    sizes = numbered.groupBy("grp").agg(F.count("*").alias("n"))
    sizes = materialize(sizes.withColumn("levels", _levels(F.col("n"))), "sizes")
    nodes = skew_join(numbered, sizes, ["grp"], "inner", null_safe=True, frequencies=lambda: _rows(sizes))
    layers = _climb(nodes, _strides(sizes), ["id", *payload])
    subroots = join_null_safe(_tops(layers), sizes.select("grp", "n"), ["grp"], "inner")
    order = materialize(dense_key(materialize(subroots, "subroots"), ["grp"], "place"), "merkle-order")
    total = F.lit(order.count()).cast("long")
    tops = order.select(
        F.lit("").alias("grp"), (F.col("place") - 1).alias("pos"), total.alias("n"),
        _levels(total).alias("levels"), F.col("top").alias("digest"),
    )
    upper = _climb(tops, _strides(tops))
    root = _tops(upper).first()
    groups = order.select("grp", (F.col("place") - 1).alias("pos"), "n", F.col("top").alias("subroot"))
    return Manifest(layers, upper, groups, bytes(root["top"]) if root else None)


_PATH = "grp string, block long, path binary"


def _child_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every child of a block: per level above it, from below, slot,
    number of children, state before the slot, and the siblings in order."""
    for batch in batches:
        for row in batch.to_pylist():
            children = _split(row["children"])
            own = [b""] * len(children)
            digests, ends = children, np.arange(len(children))
            states, inner = _split(row["states"]), _split(row["inner"])
            for _ in range(min(LEVELS, row["levels"])):
                steps = [_step(digests, states, at) for at in range(len(digests))]
                own = [path + steps[at] for path, at in zip(own, ends, strict=True)]
                states = states[len(digests) :]
                parents = -(-len(digests) // FAN)
                digests, inner, ends = inner[:parents], inner[parents:], ends // FAN
            first = row["block"] * BLOCK
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["grp"]] * len(own), pa.string()),
                    pa.array(range(first, first + len(own)), pa.int64()),
                    pa.array([path + row["path"] for path in own], pa.binary()),
                ],
                names=["grp", "block", "path"],
            )


def _split(data: bytes) -> list[bytes]:
    return [data[k : k + 32] for k in range(0, len(data), 32)]


def _step(digests: list[bytes], states: list[bytes], at: int) -> bytes:
    slot = at % FAN
    run = digests[at - slot : at - slot + FAN]
    return bytes([slot, len(run)]) + states[at] + b"".join(run[:slot] + run[slot + 1 :])


def read_path(path: bytes) -> list[tuple[int, int, bytes, bytes]]:
    """slot, children, state before the slot and siblings, per level from below."""
    found, at = [], 0
    while at < len(path):
        slot, count = path[at], path[at + 1]
        end = at + 34 + 32 * (count - 1)
        found.append((slot, count, path[at + 2 : at + 34], path[at + 34 : end]))
        at = end
    return found


def _paths(layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The path of each block of the first layer; ``tops`` has those of the groups' roots.

    From the top down, so a table of paths has one row per block.
    """
    below = None
    for depth in range(len(layers) - 1, -1, -1):
        ended = layers[depth].filter(F.col("levels") <= LEVELS).select("grp", "block")
        paths = join_null_safe(ended, tops, ["grp"], "inner").select("grp", "block", "path")
        paths = paths if below is None else paths.unionByName(below)
        if depth == 0:
            return paths
        whole = join_null_safe(layers[depth], paths, ["grp", "block"], "inner")
        kept = whole.select("grp", "block", "levels", "children", "states", "inner", "path")
        below = materialize(kept.mapInArrow(_child_paths, _PATH), "merkle-paths")


def block_paths(manifest: Manifest) -> DataFrame:
    """grp, block and path of each block of leaves, up to the root of the dataset."""
    whole = F.lit("").alias("grp"), F.lit(b"").alias("path")
    tops = manifest.groups.limit(1).select(*whole)
    held = manifest.upper[0].select("grp", "block", "levels", "children", "states", "inner")
    joined = join_null_safe(held, _paths(manifest.upper, tops), ["grp", "block"], "inner")
    by_place = materialize(joined.mapInArrow(_child_paths, _PATH), "merkle-paths")
    places = manifest.groups.select("grp", F.col("pos").alias("place"))
    of_groups = by_place.select(F.col("block").alias("place"), "path").join(places, "place").select("grp", "path")
    return _paths(manifest.layers, materialize(of_groups, "merkle-paths"))


def resume(
    states: np.ndarray, values: np.ndarray, rights: np.ndarray, counts: np.ndarray, flat: np.ndarray, at: np.ndarray
) -> np.ndarray:
    """The parents' digests: each state goes on with the child's value and the
    ``rights`` siblings after it, which follow ``at`` in ``flat``."""
    states = sha256.compress(states, sha256.hex_blocks(values))
    for step in range(1, int(rights.max(initial=0)) + 1):
        live = np.flatnonzero(rights >= step)
        states[live] = sha256.compress(states[live], sha256.hex_blocks(flat[at[live] + step]))
    return sha256.compress(states, sha256.last_blocks(counts))


def _apart(values: np.ndarray, originals: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``values`` to go on with, and for every row the one that stands
    for it: those that came out as the original are taken once per owner."""
    same = (values == originals[owner]).all(axis=1)
    stands = np.arange(len(values))
    first = np.full(owners, -1)
    rows = np.flatnonzero(same)
    first[owner[rows[::-1]]] = rows[::-1]
    stands[rows] = first[owner[rows]]
    kept = np.unique(stands)
    return kept, np.searchsorted(kept, stands)


def _fold_slice(rows: list[dict]) -> tuple[np.ndarray, list[bytes]]:
    """Folded root (words) and digest of the siblings, of all leaves of some blocks."""
    sizes = np.array([len(r["children"]) // 32 for r in rows])
    levels = np.array([r["levels"] for r in rows])
    run = np.repeat(np.arange(len(rows)), sizes)
    digests = sha256.words_of(b"".join(r["children"] for r in rows))
    values = digests.copy()
    starts = np.cumsum(sizes) - sizes
    for k, row in enumerate(rows):
        for at, changed in enumerate(row["changed"]):
            if changed is not None:
                values[starts[k] + at] = np.frombuffer(changed, ">u4")
    hashes = [hashlib.sha256() for _ in range(len(run))]
    back = np.arange(len(run))  # of each leaf: its row of values
    place = np.arange(len(run))  # of each row of values: its node
    node_of = np.arange(len(run))  # of each leaf: its node
    read = np.zeros(len(rows), int)  # states and inner nodes read so far, by block
    read_inner = np.zeros(len(rows), int)
    for level in range(LEVELS):
        slots, counts, parent, parents = places(sizes)
        live = levels > level
        if not live.any():
            break
        # The siblings, in hexadecimal, of every leaf's node.
        text = sha256.hex_blocks(digests).astype(">u4").tobytes()
        for leaf in np.flatnonzero(live[run]):
            node = node_of[leaf]
            begin = (node - slots[node]) * 64
            hashes[leaf].update(text[begin : node * 64])
            hashes[leaf].update(text[(node + 1) * 64 : begin + counts[node] * 64])
        pieces, above = [], []
        for k, row in enumerate(rows):
            held = 32 * sizes[k] if live[k] else 0
            pieces.append(row["states"][read[k] : read[k] + held] if held else b"\0" * (32 * sizes[k]))
            read[k] += held
            size = 32 * parents[k]
            # A block that has ended keeps its top.
            above.append(row["inner"][read_inner[k] : read_inner[k] + size] if held else row["top"])
            read_inner[k] += size if held else 0
        states, upper = sha256.words_of(b"".join(pieces)), sha256.words_of(b"".join(above))
        folded = values.copy()
        owner = parent[place]
        go = np.flatnonzero(live[np.repeat(np.arange(len(rows)), sizes)[place]])
        nodes = place[go]
        folded[go] = resume(states[nodes], values[go], counts[nodes] - slots[nodes] - 1, counts[nodes], digests, nodes)
        kept, stands = _apart(folded, upper, owner, len(upper))
        values, back, place = folded[kept], stands[back], owner[kept]
        node_of, digests, sizes = parent[node_of], upper, parents
    # One node is left of each block; what came out as its top goes on once.
    block = place
    kept, stands = _apart(values, digests, block, len(rows))
    values, back, block = values[kept], stands[back], block[kept]
    paths = [read_path(r["path"]) for r in rows]
    siblings = [b"".join(step[3] for step in path) for path in paths]
    for k, rest in enumerate(siblings):
        text = rest.hex().encode()
        for leaf in range(starts[k], starts[k] + (len(rows[k]["children"]) // 32)):
            hashes[leaf].update(text)
    for level in range(max(map(len, paths), default=0)):
        steps = [path[level] if level < len(path) else None for path in paths]
        right = [s[3][32 * s[0] :] if s else b"" for s in steps]
        offset = np.cumsum([0, *[len(r) // 32 for r in right]])[:-1] - 1
        go = np.flatnonzero(np.array([s is not None for s in steps])[block])
        of = block[go]
        slots, counts = (np.array([s[k] if s else 0 for s in steps])[of] for k in (0, 1))
        states = sha256.words_of(b"".join(s[2] if s else b"\0" * 32 for s in steps))[of]
        flat = sha256.words_of(b"".join(right))
        values[go] = resume(states, values[go], counts - slots - 1, counts, flat, offset[of])
    return values[back], [h.digest() for h in hashes]


_FOLDED = "grp string, id long, leaf binary, folded binary, proof binary"


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            rows = batch.slice(at, SLICE).to_pylist()
            folded, proofs = _fold_slice(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["grp"] for r in rows for _ in r["id"]], pa.string()),
                    pa.array([i for r in rows for i in r["id"]], pa.int64()),
                    pa.array([d for r in rows for d in _split(r["children"])], pa.binary()),
                    pa.array(_split(sha256.bytes_of(folded)), pa.binary()),
                    pa.array(proofs, pa.binary()),
                ],
                names=["grp", "id", "leaf", "folded", "proof"],
            )


def fold(manifest: Manifest) -> DataFrame:
    """grp, id, leaf, folded and proof (binary) of every leaf.

    ``folded`` is the root that follows from the leaf's payload column
    ``changed``, or from the leaf itself where that is null, and from the
    stored states and right siblings. ``proof`` is the hash of all siblings on
    the way up. A block's leaves share the path above the block.
    """
    held = manifest.layers[0].select("grp", "block", "levels", "children", "states", "inner", "top", "id", "changed")
    joined = join_null_safe(held, block_paths(manifest), ["grp", "block"], "inner")
    return joined.mapInArrow(_fold_blocks, _FOLDED)


def audit(
    docs: DataFrame,
    tampered: Column,
    replaced: dict[str, Column],
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Digests are lowercase hexadecimal. Where ``tampered`` holds, the root is
    folded from the leaf with the columns in ``replaced``; ``verified`` tells
    whether it is still the root. Nulls are fields of their own (``-``), an
    empty text is ``0:``. A null id or group comes first. Repeated rows are
    leaves of their own. Other columns, whatever their names, are not read. An
    empty table has no root and gives no rows.
    """
    now = leaf_digest([F.col(c) for c in fields])
    then = leaf_digest([replaced.get(c, F.col(c)) for c in fields])
    leaves = docs.select(
        F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("long").alias("id"),
        now.alias("digest"), F.when(tampered, then).alias("changed"),
    )
    manifest = build(materialize(leaves, "leaves"), ["changed"])
    groups = manifest.groups.select("grp", "subroot", F.lit(manifest.root).alias("root"))
    frequencies = _rows(manifest.groups)
    folded = skew_join(fold(manifest), groups, ["grp"], "inner", null_safe=True, frequencies=lambda: frequencies)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return folded.select(
        F.col("id").alias("doc_id"), text["leaf"].alias("leaf"), text["subroot"].alias("subroot"),
        text["root"].alias("root"), text["proof"].alias("proof_sha256"), text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
