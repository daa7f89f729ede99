"""Links between members of hash buckets, and the components that links form.

Neither step holds a bucket or a component in one task, and neither emits all pairs of a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.sources.staging import discard, staged

WIDE_BUCKET = 64
BLOCK = 512
ROUNDS_BY_ID = 2
HOT_BUCKETS = 4096
HOT_SAMPLE = 256


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of ``links`` (``a, b``); the component is its smallest id.

    Rounds of contraction: every node joins the neighbour that comes first (a map-side minimum), twice
    over, and links between merged nodes are drawn between what they became.  The first rounds go by
    id, which settles stars around small ids at once; later ones by a random order that is new each
    round, so that chains shrink by a constant factor whatever their ids.
    """
    edges = first_edges = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    spent_edges = []
    jumps: list[DataFrame] = []
    while not edges.isEmpty():
        spent = len(jumps)
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        if spent < ROUNDS_BY_ID:
            step = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("to"))
        else:
            first = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v", F.lit(spent)).alias("h"), F.col("v").alias("v"))).alias("m"))
            step = first.select(
                F.col("u").alias("node"),
                F.when(F.col("m.h") < F.xxhash64("u", F.lit(spent)), F.col("m.v")).otherwise(F.col("u")).alias("to"),
            )
        again = step.toDF("to", "further")
        jump = staged(step.join(again, "to").select("node", F.col("further").alias("to")), "jump")
        jumps.append(jump)
        spent_edges.append(edges)
        edges = staged(
            edges.join(jump.toDF("a", "x"), "a").join(jump.toDF("b", "y"), "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links",
        )
    labels = first_edges.select(F.col("a").alias("id")).union(first_edges.select("b")).distinct().select("id", F.col("id").alias("root"))
    for jump in jumps:
        labels = labels.join(jump.toDF("root", "to"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    labels = staged(labels, "labels")
    smallest = labels.groupBy("root").agg(F.min("id").alias("component"))
    found = staged(labels.join(smallest, "root").select("id", "component"), "components")
    discard(*spent_edges, edges, *jumps, labels)
    return found


def shared_buckets(members: DataFrame) -> DataFrame:
    """``bucket, id, low, n`` for every member of a bucket of two or more: its smallest id and its size.

    Members move once, by bucket.  The largest buckets, at most ``HOT_BUCKETS``, are known from a 64th of the
    ids and do not move at all: their size and smallest id are summed up where their members are.
    """
    seen = members.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(64)) == 0).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    hot = staged(seen.where(F.col("n") >= HOT_SAMPLE).orderBy(F.desc("n"), "bucket").limit(HOT_BUCKETS).select("bucket"), "hot")
    any_hot = not hot.isEmpty()
    own = Window.partitionBy("bucket")
    cold = members.join(F.broadcast(hot), "bucket", "left_anti") if any_hot else members
    found = cold.select("bucket", "id", F.min("id").over(own).alias("low"), F.count(F.lit(1)).over(own).alias("n"))
    if any_hot:
        large = members.join(F.broadcast(hot), "bucket", "left_semi").select("bucket", "id")
        found = found.union(large.join(F.broadcast(
            large.groupBy("bucket").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))), "bucket"))
    inside = staged(found.where("n > 1"), "members")
    discard(hot)
    return inside


def linked_components(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], items: Callable[[DataFrame], DataFrame], compare: Callable,
    traits: DataFrame | None = None, plausible: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """Components of the links between members of the same bucket (``bucket, id``, distinct).

    ``verify`` takes candidate pairs ``a, b`` with ``a < b`` and gives those that are links.  ``traits``
    (``id`` and small columns) with ``plausible`` (a condition on the columns of two prefixes) rule out
    pairs before their data is fetched.  ``items`` gives ``id`` and an item for rows of ``id``; it and ``compare``
    serve block comparisons, see :func:`linked_blocks`.

    First every member is compared with the smallest id of each of its buckets, in rounds: one partner a member, the
    smallest, in each of the first two, then all that are left; pairs that became one component meanwhile are
    not compared.  Where a bucket then still holds several components, its strays (members outside the component of
    that smallest id) are compared with all members of other components: pair by pair in buckets of at most
    ``WIDE_BUCKET``; the wide ones are pooled by common members, and the strays of a pool meet its
    members in blocks.  A pair is left out only if both are known to be in one component.
    """
    inside = shared_buckets(members)

    def likely(found: DataFrame) -> DataFrame:
        if traits is None:
            return found
        names = [c for c in traits.columns if c != "id"]
        left = traits.select(F.col("id").alias("a"), *[F.col(c).alias(f"x_{c}") for c in names])
        right = traits.select(F.col("id").alias("b"), *[F.col(c).alias(f"y_{c}") for c in names])
        # Both sides grow with the corpus: merged at every size.
        return found.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(plausible("x_", "y_")).select("a", "b")

    pairs = staged(likely(inside.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()), "pairs")
    links, groups = None, None
    for last in (False, False, True):
        chosen = pairs if last else staged(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "chosen")
        found = staged(verify(chosen), "verified")
        links = found if links is None else links.union(found)
        groups = components(links)
        if not last:
            ends = lambda end: groups.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))  # noqa: E731, B023
            left = staged(
                pairs.join(chosen, ["a", "b"], "left_anti").join(ends("a"), "a", "left").join(ends("b"), "b", "left")
                .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"), "pairs")
            discard(pairs, chosen)
            pairs = left
            if pairs.isEmpty():
                break
    placed = inside.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = inside.select("bucket", F.col("low").alias("id")).distinct().join(groups, "id", "left").select(
        "bucket", F.coalesce("component", "id").alias("main")
    )
    placed = placed.join(heads, "bucket")
    mixed = placed.where("component <> main").select("bucket").distinct()
    placed = staged(placed.join(mixed, "bucket").select("bucket", "id", "low", "n", "component", "main"), "mixed")
    discard(inside)
    if placed.isEmpty():
        return groups

    narrow = placed.where(F.col("n") <= WIDE_BUCKET)
    if traits is not None:
        narrow = narrow.join(traits, "id")
    x = narrow.where("component <> main").select(*[F.col(c).alias(f"x_{c}") for c in narrow.columns])
    y = narrow.where("id <> low").select(*[F.col(c).alias(f"y_{c}") for c in narrow.columns])
    both = (F.col("x_bucket") == F.col("y_bucket")) & (F.col("x_component") != F.col("y_component"))
    if plausible is not None:
        both = both & plausible("x_", "y_")
    more = x.join(y, both).select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()
    links = links.union(staged(verify(more), "verified"))

    wide = placed.where(F.col("n") > WIDE_BUCKET)
    if not wide.isEmpty():
        pools = components(wide.select(F.col("low").alias("a"), F.col("id").alias("b")))
        wide = wide.join(pools.select("id", F.col("component").alias("pool")), "id")
        strays = wide.where("component <> main").select("pool", "id").distinct()
        links = links.union(staged(linked_blocks(strays, wide.select("pool", "id").distinct(), items, compare), "verified"))
    return components(links)


def linked_blocks(x: DataFrame, y: DataFrame, items: Callable[[DataFrame], DataFrame], compare: Callable) -> DataFrame:
    """Links ``a, b`` that connect what all links between ``x`` and ``y`` of one pool connect.

    ``x`` and ``y`` are rows of ``pool, id``.  Both are dealt into blocks of about ``BLOCK`` and
    every pair of blocks of a pool is one group of bounded size: ``compare`` takes the ``item`` columns
    of both blocks and gives a boolean matrix.  Of its links a spanning forest is given out, so no
    more rows leave a group than it has members.
    """
    x, y = staged(x, "block-x"), staged(y, "block-y")

    def blocks(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("pool").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    counts = blocks(x, "nx").join(blocks(y, "ny"), "pool")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = x.join(counts, "pool").select("pool", own("nx").alias("i"), each("ny").alias("j"), F.lit(True).alias("first"), "id")
    right = y.join(counts, "pool").select("pool", each("nx").alias("i"), own("ny").alias("j"), F.lit(False).alias("first"), "id")
    keys = ["pool", "i", "j"]
    known = staged(items(x.select("id").union(y.select("id")).distinct()).toDF("id", "item"), "block-items")
    dealt = left.union(right).join(known, "id").select(*keys, "first", "id", "item").repartition(*keys).sortWithinPartitions(*keys)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in consecutive_groups(batches, keys):
            first, ids = np.asarray(group.column("first")), np.asarray(group.column("id"))
            item = group.column("item").chunk(0)
            one, two = np.flatnonzero(first), np.flatnonzero(~first)
            near = compare(item.take(pa.array(one)), item.take(pa.array(two))) & (ids[one][:, None] != ids[two][None, :])
            a, b = forest(near)
            a, b = ids[one[a]], ids[two[b]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return dealt.mapInArrow(link, "a long, b long").distinct()


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the bipartite graph of a boolean matrix, as row and column numbers."""
    rows_left, columns_left = near.any(axis=1), near.any(axis=0)
    out_a, out_b = [], []
    while rows_left.any():
        frontier = np.array([np.argmax(rows_left)])
        rows_left[frontier] = False
        while len(frontier):
            reached = near[frontier][:, columns_left].any(axis=0)
            columns = np.flatnonzero(columns_left)[reached]
            if not len(columns):
                break
            out_a.append(frontier[near[np.ix_(frontier, columns)].argmax(axis=0)])
            out_b.append(columns)
            columns_left[columns] = False
            open_rows = np.flatnonzero(rows_left)
            met = near[np.ix_(open_rows, columns)]
            hit = met.any(axis=1)
            frontier = open_rows[hit]
            out_a.append(frontier)
            out_b.append(columns[met[hit].argmax(axis=1)])
            rows_left[frontier] = False
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def consecutive_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` in a sorted stream, one table each with whole columns."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        marks = np.stack([np.asarray(held.column(k)).astype(np.int64) for k in keys])
        starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)]) if held.num_rows else []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield held.slice(a, b - a).combine_chunks()
        held = held.slice(starts[-1]) if len(starts) else held
    if held is not None and held.num_rows:
        yield held.combine_chunks()
