"""Exact top-k by inner product: branch and bound over ball trees, shard by shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railwatch.sources.staging import ship_package, staged

SHARD_ROWS = 1024
QUERY_BLOCK = 1024
LEAF_ROWS = 48
NOTHING = -(1 << 62)  # below every score; its negative still fits


class BallTree:
    """Balls around halves of the vectors, halved again down to leaves.

    For a ball with centre c and radius r, no vector inside has an inner product with q above
    q.c + |q| r.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        self.order = np.arange(len(vectors))
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.parents: list[int] = []
        self.leaves: list[tuple[int, int, int]] = []
        self._vectors = vectors.astype(np.float64)
        if len(vectors):
            self._grow(0, len(vectors), -1)
        self.vectors, self.ids = vectors[self.order], ids[self.order]

    def _grow(self, start: int, end: int, parent: int) -> None:
        stack = [(start, end, parent)]
        while stack:
            a, b, above = stack.pop()
            x = self._vectors[self.order[a:b]]
            centre = x.mean(axis=0)
            away = np.sqrt(((x - centre) ** 2).sum(axis=1))
            node = len(self.radii)
            self.centres.append(centre)
            self.radii.append(float(away.max()))
            self.parents.append(above)
            if b - a <= LEAF_ROWS or self.radii[-1] == 0:
                self.leaves.append((a, b, node))
                continue
            # Split between the farthest point and the point farthest from it.
            one = x[np.argmax(away)]
            two = x[np.argmax(((x - one) ** 2).sum(axis=1))]
            side = np.argsort(x @ (two - one), kind="stable")
            self.order[a:b] = self.order[a:b][side]
            middle = (a + b) // 2
            stack += [(a, middle, node), (middle, b, node)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of each query in each leaf: the least over the leaf and the balls above it."""
        centres, radii = np.array(self.centres), np.array(self.radii)
        norms = np.sqrt((queries * queries).sum(axis=1))
        upper = queries @ centres.T + norms[:, None] * radii[None, :]
        for node in range(1, len(radii)):  # parents come before children
            upper[:, node] = np.minimum(upper[:, node], upper[:, self.parents[node]])
        # Above rounding of the sums, so that equal scores are still visited.
        return upper[:, [n for _, _, n in self.leaves]] * (1 + 1e-9) + 1e-6 * (1 + norms[:, None])

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, ids and scores of the best ``k`` candidates that reach ``floor``.

        Leaves are visited in falling order of their bound until it lies below the kth score so
        far; the first kth score is the one that other shards have reached already.
        """
        n = len(queries)
        best = np.full((n, k), NOTHING)
        best_id = np.full((n, k), np.iinfo(np.int64).max)
        kth = floor.astype(np.float64)
        wide = queries.astype(np.float64)
        upper = self.bounds(wide)
        visit = np.argsort(-upper, axis=1, kind="stable")
        for turn in range(upper.shape[1]):
            leaf_of = visit[:, turn]
            alive = np.flatnonzero(upper[np.arange(n), leaf_of] >= kth)
            if not len(alive):
                break
            for leaf in np.unique(leaf_of[alive]):
                rows = alive[leaf_of[alive] == leaf]
                a, b, _ = self.leaves[leaf]
                ids = np.broadcast_to(self.ids[a:b], (len(rows), b - a))
                scores = queries[rows] @ self.vectors[a:b].T
                scores = np.where(ids == own[rows][:, None], NOTHING, scores)
                all_scores, all_ids = np.hstack([best[rows], scores]), np.hstack([best_id[rows], ids])
                order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best[rows] = np.take_along_axis(all_scores, order, 1)
                best_id[rows] = np.take_along_axis(all_ids, order, 1)
                full = best[rows, -1]
                kth[rows] = np.maximum(kth[rows], np.where(full > NOTHING, full, -np.inf))
        real = (best > NOTHING) & (best >= floor[:, None])
        row, place = np.nonzero(real)
        return row, best_id[row, place], best[row, place]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    from railwatch.llm.vectors import matrix

    return matrix(column, dimension).astype(np.int64)


def _search(pairs: DataFrame, k: int, dimension: int) -> DataFrame:
    """Rows (``shard, block, is_query, id, vector, floor``), sorted by shard and block, to candidates."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            shard, block = np.asarray(held.column("shard")), np.asarray(held.column("block"))
            starts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (block[1:] != block[:-1])])
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield held.slice(a, b - a)
            held = held.slice(starts[-1]) if len(starts) else held
        if held is not None and held.num_rows:
            yield held

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            group = group.combine_chunks()
            asks = np.asarray(group.column("is_query"))
            ids = np.asarray(group.column("id"))
            x = _matrix(group.column("vector").chunk(0), dimension)
            floor = group.column("floor").fill_null(NOTHING).to_numpy()[asks]
            tree = BallTree(x[~asks], ids[~asks])
            if not asks.any() or asks.all():
                continue
            row, found, score = tree.search(x[asks], ids[asks], floor, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[asks][row]), pa.array(found), pa.array(score)], names=["query_id", "id", "score"]
            )

    return pairs.mapInArrow(search, "query_id long, id long, score long")


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` highest inner products of every query, ties to smaller ids.

    ``rows`` and ``queries`` hold integer vectors (arrays of long) under the same column names.  Rows
    are dealt by a hash of their id into shards of about ``SHARD_ROWS``, queries into blocks of about
    ``QUERY_BLOCK``; a task searches one block in one shard's ball tree and so holds neither side
    whole.  A first pass searches each query in one shard only; the kth score it reaches is the
    floor of the search in all shards.

    Null vectors and vectors that hold null, and null ids, take no part on either side.  Vectors of
    unequal length are filled with zeros; an empty vector scores 0.  A query never gets a row of its
    own id.  Repeated equal rows count once.  Other columns are not carried.  An empty table gives an
    empty result.
    """
    spark = rows.sparkSession
    ship_package(spark)
    good = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    take = lambda df: df.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<long>").alias("vector")
    ).where(good).distinct()
    vectors, asked = staged(take(rows), "topk-rows"), staged(take(queries), "topk-queries")
    n, dimension = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    m, wide = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    dimension = max(dimension, wide)
    shards, blocks = -(-n // SHARD_ROWS), -(-m // QUERY_BLOCK)
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    stored = vectors.select(shard.alias("shard"), every(blocks).alias("block"), F.lit(False).alias("is_query"), "id", "vector", F.lit(None).cast("long").alias("floor"))

    def searched(questions: DataFrame) -> DataFrame:
        dealt = stored.unionByName(questions).repartition("shard", "block").sortWithinPartitions("shard", "block")
        return _search(dealt, k, dimension)

    first = searched(asked.select(
        shard.alias("shard"), block.alias("block"), F.lit(True).alias("is_query"), "id", "vector", F.lit(None).cast("long").alias("floor")
    ))
    reached = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("floor")).where(F.col("found") == k)
    floors = staged(reached.select(F.col("query_id").alias("id"), "floor"), "topk-floors")
    candidates = searched(asked.join(floors, "id", "left").select(
        every(shards).alias("shard"), block.alias("block"), F.lit(True).alias("is_query"), "id", "vector", "floor"
    ))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    once = candidates.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
