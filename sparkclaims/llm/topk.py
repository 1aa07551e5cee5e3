"""Exact top-k by inner product as a Voronoi kNN join.

With one more coordinate, sqrt(M^2 - |x|^2) for data and 0 for queries, where
M is the largest norm, the distance of a query and a row falls as their inner
product grows: d^2 = |q|^2 + M^2 - 2 q.x. So the k best rows are the k nearest.

Queries and data are grouped by their nearest pivot. The summary of a data
group is its rows nearest to the pivot. They bound the distance of each
query's k-th neighbour, and a query group's reach is the largest sum of a
query's distance to the pivot and its bound. By the triangle inequality only
rows within the reach of the pivot can be among the group's answers: these are
copied to the group, in blocks, and searched there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclaims.storage import materialize

#: Rows the pivots are fitted on, and pivots, at most: they bound what the driver holds.
SAMPLE_ROWS, PIVOTS = 8_192, 256
#: Queries of a group, on the average.
GROUP_QUERIES = 512
#: A group's rows are cut in blocks of the first size, or in up to ``BLOCKS`` of the second.
BLOCK_ROWS, SMALL_BLOCK, BLOCKS = 65_536, 1_024, 64
#: Scores held at once in a task.
TILE = 1 << 21
#: Share of the largest norm that covers the rounding of distances.
SLACK = 1e-6
#: Squared norms from which a score may not fit a long.
LARGEST = 2.0**62

_ANSWERS = "query_id long, query_row long, vec_id long, vec_row long, score long"


def codes(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(F.coalesce(sound, F.lit(False)), whole)


class _Space:
    """The pivots and the largest squared norm; distances with the added coordinate."""

    def __init__(self, dims: int, largest: float, pivots: np.ndarray):
        self.dims, self.largest, self.pivots = dims, largest, pivots
        self.slack = SLACK * (math.sqrt(largest) + 1)
        # Inner products of such vectors are exact in doubles.
        self.exact = largest < 2.0**53

    def matrix(self, batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        """The vectors as rows; a shorter one ends in zeros."""
        lists = batch.column("codes")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        out = np.zeros((len(lists), self.dims), np.int64)
        sizes = np.diff(lists.offsets.to_numpy())
        rows = np.repeat(np.arange(len(lists)), sizes)
        out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
        return out.astype(np.float64) if self.exact else out

    def lifted(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        """With the added coordinate, as doubles."""
        vectors = vectors.astype(np.float64)
        rest = np.maximum(self.largest - (vectors**2).sum(1), 0) if data else np.zeros(len(vectors))
        return np.column_stack([vectors, np.sqrt(rest)])

    def to_pivots(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        return _distances(self.lifted(vectors, data), self.pivots)

    def scores(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return queries @ rows.T


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Means of ``count`` groups: far points first, then a few rounds of means."""
    count = min(count, len(sample))
    pivots = sample[:1]
    nearest = _distances(sample, pivots)[:, 0]
    while len(pivots) < count and nearest.max() > 0:
        pivots = np.vstack([pivots, sample[np.argmax(nearest)]])
        nearest = np.minimum(nearest, _distances(sample, pivots[-1:])[:, 0])
    for _ in range(4):
        home = _distances(sample, pivots).argmin(1)
        sizes = np.bincount(home, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, home, sample)
        pivots = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], pivots)
    return pivots


def _candidates(rows: DataFrame, k: int) -> DataFrame:
    """Marks what can be an answer: of equal vectors only the k + 1 smallest ids
    can (one may be the query's own). Each task limits its copies before the shuffle."""
    place = F.row_number().over(Window.partitionBy("codes").orderBy(F.col("id").asc_nulls_first(), "row_no"))
    return rows.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")


def _assigned(space: _Space, data: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = space.to_pivots(space.matrix(batch), data)
            home = far.argmin(1)
            added = [pa.array(home, pa.int32()), pa.array(far[np.arange(len(home)), home], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "cell", "far"])

    return assign


def _bounded(space: _Space, summary: pa.Table, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per query: the k-th best score among the summaries' rows, and the reach that follows."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids = space.matrix(summary), _ids(summary.column("id"))
        for batch in batches:
            vectors, own = space.matrix(batch), _ids(batch.column("id"))
            floors = np.full(len(vectors), -np.inf)
            step = max(1, TILE // max(1, len(known)))
            for at in range(0, len(vectors), step):
                found = space.scores(vectors[at : at + step], known).astype(np.float64)
                found[own[at : at + step, None] == ids[None, :]] = -np.inf
                if len(known) >= k:
                    floors[at : at + step] = np.partition(found, len(known) - k, axis=1)[:, len(known) - k]
            squares = (vectors.astype(np.float64) ** 2).sum(1) + space.largest - 2 * floors
            reach = batch.column("far").to_numpy() + np.sqrt(np.maximum(squares, 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(floors), pa.array(reach)], names=[*batch.schema.names, "floor", "reach"]
            )

    return bound


#: Stands for a null id, which no query has.
_NO_ID = np.iinfo(np.int64).min


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy()


def _wanted(space: _Space, cells: np.ndarray, reach: np.ndarray, groups: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per data row the query groups with a cell whose reach holds it."""

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        belongs = np.zeros((len(cells), int(groups.max()) + 1), np.float32)
        belongs[np.arange(len(cells)), groups] = 1
        for batch in batches:
            near = space.to_pivots(space.matrix(batch), True)[:, cells] <= reach[None, :] + space.slack
            row, group = np.nonzero(near.astype(np.float32) @ belongs)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(group, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "groups"])

    return want


def _chained(pivots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Group of each query cell: cells along a chain of near pivots are taken
    together until they have ``GROUP_QUERIES`` queries."""
    left, order = set(range(len(pivots))), []
    far = _distances(pivots, pivots)
    at = 0
    while left:
        left.discard(at)
        order.append(at)
        at = min(left, key=lambda other: (far[order[-1], other], other), default=0)
    groups, group, held = np.zeros(len(pivots), int), 0, 0
    for cell in order:
        if held >= GROUP_QUERIES:
            group, held = group + 1, 0
        groups[cell], held = group, held + counts[cell]
    return groups


def _searched(space: _Space, k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _answers(np.zeros((0, 5), np.int64))
        order = np.lexsort((rows.column("row_no").to_numpy(), _ids(rows.column("id"))))
        rows = rows.take(pa.array(order))
        ids, data, vectors = _ids(rows.column("id")), space.matrix(rows), space.matrix(queries)
        own, floors = _ids(queries.column("id")), queries.column("floor").to_numpy().copy()
        best = np.zeros((0, 3), np.int64)  # query, row and score
        step = max(1, TILE // len(vectors))
        for at in range(0, len(data), step):
            found = space.scores(vectors, data[at : at + step])
            query, row = np.nonzero((found >= floors[:, None]) & (own[:, None] != ids[None, at : at + step]))
            new = np.column_stack([query, row + at, found[query, row].astype(np.int64)])
            best = np.concatenate([best, new])
            best = best[np.lexsort((best[:, 1], -best[:, 2], best[:, 0]))]
            rank = np.arange(len(best)) - np.searchsorted(best[:, 0], best[:, 0])
            best = best[rank < k]
            full = np.flatnonzero(rank[rank < k] == k - 1)
            floors[best[full, 0]] = np.maximum(floors[best[full, 0]], best[full, 2])
        query, row, score = best.T
        row_nos, query_nos = rows.column("row_no").to_numpy(), queries.column("row_no").to_numpy()
        return _answers(np.column_stack([own[query], query_nos[query], ids[row], row_nos[row], score]))

    return search


def _answers(found: np.ndarray) -> pa.Table:
    names = ["query_id", "query_row", "vec_id", "vec_row", "score"]
    columns = {n: pa.array(found[:, k], pa.int64(), mask=found[:, k] == _NO_ID) for k, n in enumerate(names)}
    return pa.table(columns)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64
) -> DataFrame:
    """query_id, rank (int, from 1), vec_id and score of the ``k`` rows with the
    largest inner product with each query (all, if fewer), ties to smaller ids.

    Vectors count as floor(``scale`` * x). Queries are the rows of ``vectors``
    where ``is_query`` holds; the rows with a query's own id are not among its
    answers. A vector that is null or has a null or non-finite component takes
    no part. A shorter vector counts as ending in zeros, an empty one scores 0.
    Repeated rows answer each for itself, and a repeated query is answered each
    time. A row without an id is no query; as an answer it comes before equal
    scores. Other columns are not read. An empty table gives no rows. A vector
    of a squared norm of 2^62 or more raises, since scores might not fit a long.

    The driver holds a sample, the pivots and the rows nearest to them, all of
    bounded number. A group of queries meets the rows in its reach in blocks,
    so no task holds a whole group; equal rows are limited before the shuffle.
    """
    spark = vectors.sparkSession
    rows = materialize(
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.monotonically_increasing_id().alias("row_no"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            codes(F.col(vector_col), scale).alias("codes"),
        ).filter("codes IS NOT NULL"),
        "vectors",
    )
    norm = F.aggregate("codes", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    largest, dims, count = rows.agg(F.max(norm), F.max(F.size("codes")), F.count("*")).first()
    if not count:
        return _ranked(spark.createDataFrame([], _ANSWERS), k)
    if largest >= LARGEST:
        raise ValueError("a vector's squared norm is 2^62 or more")
    space = _Space(max(1, dims), largest, np.zeros((0, dims + 1)))
    sample = rows.orderBy(F.xxhash64("id", "row_no"), "row_no").limit(SAMPLE_ROWS).select("codes").toArrow()
    wished = min(PIVOTS, math.isqrt(count) + 1)
    space.pivots = fit_pivots(space.lifted(space.matrix(sample), True), wished)

    held = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = f"{held}, cell int, far double"
    data = materialize(_candidates(rows, k).mapInArrow(_assigned(space, True), placed), "data")
    # The k + 1 rows nearest to each pivot.
    nearest = F.row_number().over(Window.partitionBy("cell").orderBy("far", "row_no"))
    summary = data.withColumn("near", nearest).filter(F.col("near") <= k + 1).select("id", "codes").toArrow()
    asked = rows.filter(F.col("asks") & F.col("id").isNotNull()).mapInArrow(_assigned(space, False), placed)
    queries = materialize(
        asked.mapInArrow(_bounded(space, summary, k), f"{placed}, floor double, reach double"), "queries"
    )
    # One row per cell.
    cells = queries.groupBy("cell").agg(F.max("reach").alias("reach"), F.count("*").alias("n")).orderBy("cell").toArrow()
    if not cells.num_rows:
        return _ranked(spark.createDataFrame([], _ANSWERS), k)
    own, reach, counts = (cells.column(c).to_numpy() for c in ("cell", "reach", "n"))
    groups = _chained(space.pivots[own], counts)
    parts = -(-np.bincount(groups, weights=counts).astype(int) // (2 * GROUP_QUERIES))
    wanted = materialize(
        data.mapInArrow(_wanted(space, own, reach, groups), f"{placed}, groups array<int>"), "wanted"
    )
    sizes = np.zeros(len(parts), int)
    for group, size in wanted.select(F.explode("groups").alias("g")).groupBy("g").count().collect():
        sizes[group] = size
    blocks = np.maximum(-(-sizes // BLOCK_ROWS), np.minimum(-(-sizes // SMALL_BLOCK), BLOCKS))

    def number(of: np.ndarray, at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(n)) for n in of]), at + 1)

    group_of_cell = np.zeros(len(space.pivots), int)
    group_of_cell[own] = groups
    dealt = F.xxhash64("row_no")
    ask = queries.withColumn("g", number(group_of_cell, F.col("cell"))).filter(number(blocks, F.col("g")) > 0)
    ask = ask.withColumn("part", F.pmod(dealt, number(parts, F.col("g"))).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), number(blocks, F.col("g")) - 1))
    )
    have = wanted.select("id", "row_no", "codes", F.explode("groups").alias("g"))
    have = have.withColumn("block", F.pmod(dealt, number(blocks, F.col("g"))).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), number(parts, F.col("g")) - 1))
    )
    unit = ["g", "part", "block"]
    found = (
        ask.select(*unit, "id", "row_no", "codes", "floor").groupBy(*unit)
        .cogroup(have.select(*unit, "id", "row_no", "codes").groupBy(*unit))
        .applyInArrow(_searched(space, k), _ANSWERS)
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_first(), "vec_row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
