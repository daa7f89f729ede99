"""Near-duplicate vectors by Euclidean p-stable hashing, confirmed by exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import mix
from railwatch.llm.linking import linked_components
from railwatch.sources.staging import ship_package, staged

WIDTH = 2.0  # of a quantised projection
BLOCK = 256


def meeting_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at this distance share a cell of one Gaussian projection."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Projections a table and number of tables.

    Enough projections that unrelated (orthogonal) vectors rarely meet in a table of ``rows`` rows, and
    enough tables that a pair at the threshold meets in one of them with chance ``recall``.
    """
    near, far = meeting_chance(math.sqrt(2 - 2 * cosine)), meeting_chance(math.sqrt(2))
    depth = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)) + 2)
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - near**depth))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A list column as rows of doubles; shorter vectors are filled with zeros."""
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    if len(lengths) and (lengths == dimension).all():
        return flat.reshape(len(lengths), dimension)
    out = np.zeros((len(lengths), dimension))
    ends = np.r_[0, np.cumsum(lengths)]
    for i, n in enumerate(lengths):
        out[i, :n] = flat[ends[i]:ends[i] + n]
    return out


def usable(df: DataFrame, column: str):
    """Whether a vector is not null, holds no null, NaN or infinity, and is not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0)


def _buckets(vectors: DataFrame, dimension: int, depth: int, tables: int, seed: int) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        lines = rng.normal(size=(dimension, depth * tables)) / WIDTH
        shift = rng.random(depth * tables)
        multiplier = rng.integers(1, 1 << 62, depth, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        number = mix(np.arange(1, tables + 1, dtype=np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column(1), dimension)
                norm = np.linalg.norm(x, axis=1)
                cells = np.floor((x / norm[:, None]) @ lines + shift).astype(np.int64).reshape(len(x), tables, depth)
                value = mix((mix(cells.view(np.uint64) + number[None, :, None]) * multiplier).sum(axis=2, dtype=np.uint64) ^ number)
                yield pa.RecordBatch.from_arrays([
                    pa.array(value.view(np.int64).ravel()), part.column(0).take(pa.array(np.repeat(np.arange(len(x)), tables))),
                ], names=["bucket", "id"])

    return vectors.select("id", "vector").mapInArrow(hashed, "bucket long, id long")


def _close(pairs: DataFrame, cosine: float, dimension: int) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = matrix(batch.column(2), dimension), matrix(batch.column(3), dimension)
            value = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            mask = pa.array(value >= cosine)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def _link_counts(vectors: DataFrame, groups: DataFrame, cosine: float, dimension: int) -> DataFrame:
    """``id, links``: rows within the component at this cosine, counted in blocks of bounded size.

    All links of a vector are inside its component.  A component's vectors are dealt into blocks
    and each pair of blocks is one small matrix product, so a task never holds a large component
    and no pair becomes a row.
    """
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = groups.join(sizes, "component").withColumn("_blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    )
    dealt = placed.join(vectors, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "copies", "vector"
    )
    keys = ["component", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            marks = np.stack([np.asarray(held.column(k)) for k in keys])
            last = np.flatnonzero((marks != marks[:, -1:]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield _count_groups(held.slice(0, cut), marks[:, :cut], cosine, dimension)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield _count_groups(held, np.stack([np.asarray(held.column(k)) for k in keys]), cosine, dimension)

    return dealt.mapInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def _count_groups(table: pa.Table, marks: np.ndarray, cosine: float, dimension: int) -> pa.RecordBatch:
    table = table.combine_chunks()
    x = matrix(table.column("vector").chunk(0), dimension)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    copies, own = np.asarray(table.column("copies")), np.asarray(table.column("own"))
    starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])
    links = np.zeros(len(x), np.int64)
    for a, b in zip(starts, [*starts[1:], len(x)], strict=True):
        low, high = marks[1, a], marks[2, a]
        if low == high:
            near = x[a:b] @ x[a:b].T >= cosine
            np.fill_diagonal(near, False)
            links[a:b] = near @ copies[a:b]
        else:
            left, right = a + np.flatnonzero(own[a:b] == low), a + np.flatnonzero(own[a:b] == high)
            near = x[left] @ x[right].T >= cosine
            links[left], links[right] = near @ copies[right], near.T @ copies[left]
    return pa.RecordBatch.from_arrays([table.column("id").combine_chunks(), pa.array(links)], names=["id", "links"])


def near_vectors(
    rows: DataFrame, cosine: float = 0.9, recall: float = 0.95, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row.

    Normalised vectors are projected on Gaussian lines, quantised, and bucketed in several tables
    (see :func:`plan`); candidates are confirmed by the cosine in double precision.  ``recall`` is
    the chance for a single pair just at the threshold; closer pairs and pairs with common
    neighbours are found more surely.  Links of a vector are then counted against its whole component.

    Equal vectors enter as one and link with each other.  Null, zero and non-finite vectors and
    vectors holding null link with nothing: no links, a component of their own, kept.  Vectors of
    unequal length are filled with zeros.  Rows with a null id have a null component and are not kept.
    Rows that repeat an id with an equal vector count as links of each other; an id with different
    vectors stands for all of them.  Other columns are not carried.  An empty table gives an empty
    result.
    """
    ship_package(rows.sparkSession)
    data = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    good = usable(data, "vector") & F.col("id").isNotNull()
    print_cols = [F.xxhash64("vector").alias("_p1"), F.xxhash64(F.lit(1), "vector").alias("_p2")]
    keyed = data.where(good).select("id", *print_cols)
    sets = staged(keyed.groupBy("_p1", "_p2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-sets")
    # A vector that several sets could share an id with is met once per set by its prints.
    leading = data.where(good).select("id", "vector", *print_cols).join(
        sets.select("_p1", "_p2", F.col("rep").alias("id"), "copies"), ["_p1", "_p2", "id"]
    ).dropDuplicates(["_p1", "_p2"])
    vectors = staged(leading.select("id", "vector", "copies"), "vectors")
    count, dimension = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if count:
        depth, tables = plan(count, cosine, recall)
        members = staged(_buckets(vectors, dimension, depth, tables, seed).distinct(), "vector-buckets")

        def verify(pairs: DataFrame) -> DataFrame:
            one = pairs.join(vectors.select(F.col("id").alias("a"), F.col("vector").alias("x")), "a")
            both = one.join(vectors.select(F.col("id").alias("b"), F.col("vector").alias("y")), "b")
            return _close(both.select("a", "b", "x", "y"), cosine, dimension).distinct()

        def compare(one: pa.Array, two: pa.Array) -> np.ndarray:
            x, y = (matrix(side, dimension) for side in (one, two))
            return (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T >= cosine

        items = lambda ids: vectors.join(ids, "id", "left_semi").select("id", "vector")
        groups = linked_components(members, verify, items, compare)
        links = _link_counts(vectors, groups, cosine, dimension)
    else:
        groups = data.sparkSession.createDataFrame([], "id long, component long")
        links = data.sparkSession.createDataFrame([], "id long, links long")
    placed = sets.join(groups.toDF("rep", "component"), "rep", "left").join(links.toDF("rep", "links"), "rep", "left").select(
        F.col("_p1").alias("_q1"), F.col("_p2").alias("_q2"), F.coalesce("component", "rep").alias("_component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
    )
    every = data.select("id", F.when(good, F.xxhash64("vector")).alias("_p1"), F.when(good, F.xxhash64(F.lit(1), "vector")).alias("_p2"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    return every.join(placed, (F.col("_p1") == F.col("_q1")) & (F.col("_p2") == F.col("_q2")), "left").select(
        F.col("id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
