"""Line dedup that can be undone: exact reference counts behind sharded cuckoo filters.

The state holds, for every line key, the number of documents that have it.  Inserting documents adds to
the counts and deleting them subtracts, so any order of both gives the same state.  Keys that reach
the threshold enter the cuckoo filter of their shard, keys that fall below leave it; only a shard with such
keys changes.  A shard also lists the keys of its counts that are below the threshold and still pass
its filter.  For documents of the state, whose keys all are in the counts, filter and list together are
exact, in some four bytes a frequent key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import _IS_SPACE, Slab, joined, lowered, mix, slabs
from railwatch.sources.staging import ship_package, staged

SHARD_KEYS = 1 << 17
FILTER_BYTES = 32 << 20
HOT_KEYS = 1 << 16
KICKS = 256


@dataclass
class Lines:
    """The lines of a slab: their spans and rows, and the digest of each key that counts."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    counted: np.ndarray  # lines whose key is long enough
    digest: np.ndarray  # two numbers for each of those


def lines_of(slab: Slab, least_points: int) -> Lines:
    """A key is the line without ASCII white space at both ends, A-Z as a-z; its digest the first half of SHA-256."""
    data = slab.data
    breaks = np.flatnonzero(data == 10)
    lines = 1 + np.bincount(np.searchsorted(slab.offsets, breaks, side="right") - 1, minlength=slab.rows)
    first, last = np.cumsum(lines) - lines, np.cumsum(lines) - 1
    inner, outer = np.ones(lines.sum(), bool), np.ones(lines.sum(), bool)
    inner[first], outer[last] = False, False
    start, end = np.empty(len(inner), np.int64), np.empty(len(inner), np.int64)
    start[first], start[inner] = slab.offsets[:-1], breaks + 1
    end[last], end[outer] = slab.offsets[1:], breaks
    row = np.repeat(np.arange(slab.rows), lines)
    shown = np.flatnonzero(~_IS_SPACE[data])
    one, two = np.searchsorted(shown, start), np.searchsorted(shown, end) - 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    full = np.flatnonzero(two >= one)
    key_start, key_end = shown[one[full]], shown[two[full]] + 1
    long = points[key_end] - points[key_start] >= least_points
    counted, key_start, key_end = full[long], key_start[long], key_end[long]
    raw = lowered(data).tobytes()
    digests = b"".join(hashlib.sha256(raw[a:b]).digest()[:16] for a, b in zip(key_start.tolist(), key_end.tolist(), strict=True))
    return Lines(start, end, row, counted, np.frombuffer(digests, "<i8").reshape(-1, 2))


class Cuckoo:
    """Buckets of four 32-bit fingerprints; each key has two buckets and may be taken out again."""

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots

    @classmethod
    def room_for(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(0, int(np.ceil(np.log2(max(keys, 1) / 3.4))))
        return cls(np.zeros((buckets, 4), np.uint32))

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter that holds ``keys`` (rows of two numbers), larger if they find no place."""
        found = cls.room_for(len(keys))
        while not all(found.add(*place) for place in zip(*(x.tolist() for x in found.places(keys)), strict=True)):
            found = cls(np.zeros((2 * len(found.slots), 4), np.uint32))
        return found

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket of every key."""
        mark = (keys[:, 1].view(np.uint64) >> np.uint64(32)).astype(np.int64)
        mark[mark == 0] = 1
        return mark, (keys[:, 1].view(np.uint64) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(np.asarray(mark, np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mark, bucket = self.places(keys)
        wanted = mark.astype(np.uint32)[:, None]
        return (self.slots[bucket] == wanted).any(axis=1) | (self.slots[self.other(mark, bucket)] == wanted).any(axis=1)

    def add(self, mark: int, bucket: int) -> bool:
        """Put in one fingerprint; false, and the filter as it was, if ``KICKS`` moves find no place."""
        moved = []
        for kick in range(KICKS):
            for at in (bucket, int(self.other(np.array([mark]), np.array([bucket]))[0])):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = mark
                    return True
            slot = (kick * 2654435761 >> 7) & 3
            moved.append((at, slot))
            mark, self.slots[at, slot] = int(self.slots[at, slot]), mark
            bucket = at
        for at, slot in reversed(moved):
            mark, self.slots[at, slot] = int(self.slots[at, slot]), mark
        return False

    def remove(self, mark: int, bucket: int) -> None:
        for at in (bucket, int(self.other(np.array([mark]), np.array([bucket]))[0])):
            held = np.flatnonzero(self.slots[at] == mark)
            if len(held):
                self.slots[at, held[0]] = 0
                return
        raise KeyError("the key is not in the filter")


@dataclass(frozen=True)
class LineState:
    """``counts`` (``h1, h2, n``) and ``filters`` (``shard, slots, passing``) as written tables.

    A key is frequent from ``least_documents`` rows of documents on; keys of fewer than ``least_points`` code points
    never are.
    """

    counts: DataFrame | None = None
    filters: DataFrame | None = None
    shards: int = 0
    least_documents: int = 10
    least_points: int = 1

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineState:
        """The state with the rows of ``docs`` added; every row is a document of its own."""
        return self._changed(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineState:
        """The state without ``docs``, which must have been inserted; an error where a count would fall below zero."""
        return self._changed(docs, text_col, -1)

    def _changed(self, docs: DataFrame, text_col: str, sign: int) -> LineState:
        change = document_counts(docs, text_col, self.least_points).select("h1", "h2", (F.lit(sign) * F.col("m")).alias("change"), F.lit(0).cast("long").alias("was"))
        if self.counts is not None:
            change = change.union(self.counts.select("h1", "h2", F.lit(0).cast("long"), F.col("n")))
        summed = change.groupBy("h1", "h2").agg(F.sum("was").alias("was"), F.sum(F.col("was") + F.col("change")).alias("n"))
        checked = summed.withColumn("n", F.when(F.col("n") >= 0, F.col("n")).otherwise(F.raise_error(F.lit("documents were deleted that had not been inserted")).cast("long")))
        counts = staged(checked, "line-counts")
        shards = 1 << max(0, (-(-counts.count() // SHARD_KEYS) - 1).bit_length())
        filters = staged(_filters(counts, self.filters if shards == self.shards else None, shards, self.least_documents), "line-filters")
        return replace(self, counts=counts.where("n > 0").select("h1", "h2", "n"), filters=filters, shards=shards)


def document_counts(docs: DataFrame, text_col: str, least_points: int) -> DataFrame:
    """``h1, h2, m``: documents that have a key, summed for each slab of texts."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(0)):
                found = lines_of(slab, least_points)
                keys, number = np.unique(found.digest, axis=0, return_inverse=True)
                of_row = np.unique(found.row[found.counted] * max(len(keys), 1) + number.reshape(-1))
                m = np.bincount(of_row % max(len(keys), 1), minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(m.astype(np.int64))], names=["h1", "h2", "m"])

    return docs.select(F.col(text_col)).mapInArrow(count, "h1 long, h2 long, m long")


_FILTERS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("slots", T.BinaryType()), T.StructField("passing", T.BinaryType()),
])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys[:, 0].view(np.uint64) & np.uint64(shards - 1)).astype(np.int64)


def _filters(counts: DataFrame, before: DataFrame | None, shards: int, least: int) -> DataFrame:
    """The filters of all shards; a shard of about ``SHARD_KEYS`` keys is one task's work."""

    def build(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        pairs = np.ascontiguousarray(keys[["h1", "h2"]].to_numpy(np.int64).reshape(-1, 2))
        now, was = keys["n"].to_numpy() >= least, keys["was"].to_numpy() >= least
        held = None
        if len(old):
            held = Cuckoo(np.frombuffer(old["slots"].iloc[0], np.uint32).reshape(-1, 4).copy())
            for k in np.flatnonzero(was & ~now):
                held.remove(*(int(x[0]) for x in held.places(pairs[k:k + 1])))
            for k in np.flatnonzero(now & ~was):
                if not held.add(*(int(x[0]) for x in held.places(pairs[k:k + 1]))):
                    held = None
                    break
        if held is None:
            held = Cuckoo.of(pairs[now])
        rare = pairs[~now & (keys["n"].to_numpy() > 0)]
        passing = rare[held.holds(rare)]
        shard = keys["shard"].iloc[0] if len(keys) else old["shard"].iloc[0]
        return pd.DataFrame({"shard": [shard], "slots": [held.slots.tobytes()], "passing": [passing.tobytes()]})

    dealt = counts.withColumn("shard", F.col("h1").bitwiseAND(F.lit(shards - 1)).cast("int"))
    if before is None:
        before = counts.sparkSession.createDataFrame([], _FILTERS)
    return before.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(build, _FILTERS)


class Members:
    """The frequent keys of a state as its filters know them, for keys that its counts hold."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]], shards: int) -> None:
        self.shards = shards
        self.filters = {shard: Cuckoo(np.frombuffer(slots, np.uint32).reshape(-1, 4)) for shard, slots, _ in rows}
        self.passing = {bytes(p[k:k + 16]) for _, _, p in rows for k in range(0, len(p), 16)}

    def frequent(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        keys = np.ascontiguousarray(keys)
        shard = _shard(keys, self.shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows) and int(shard[rows[0]]) in self.filters:
                out[rows] = self.filters[int(shard[rows[0]])].holds(keys[rows])
        if self.passing:
            for k in np.flatnonzero(out):
                out[k] = keys[k].tobytes() not in self.passing
        return out


def _kept(schema: T.StructType, least_points: int, frequent):
    """Arrow function from ``id, text[, hits]`` to ``id, n_lines, n_dropped, kept``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = frequent()
        for batch in batches:
            for slab in slabs(batch.column(1)):
                found = lines_of(slab, least_points)
                drop = np.zeros(len(found.start), bool)
                drop[found.counted] = test(found, batch, slab)
                on = ~drop
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(slab.first, slab.rows), pa.array(np.bincount(found.row, minlength=slab.rows).astype(np.int64)),
                    pa.array(np.bincount(found.row[drop], minlength=slab.rows).astype(np.int64)),
                    joined(slab.data, found.start[on], found.end[on], found.row[on], slab.rows, 10),
                ], names=schema.names)

    return keep


def without_frequent_lines(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_lines, n_dropped, kept`` for every row of ``docs``, which must be documents of the state.

    Texts are split at line feeds.  All lines with a frequent key go, the others stay, joined by line
    feeds.  Where the filters take at most ``FILTER_BYTES`` every task gets them and no text is shuffled;
    beyond that keys meet the counts in a join, by text digest, and the answers go back to the texts.
    Documents that were never inserted: insert them first (and delete them after).

    Null and empty texts are one empty line, which stays.  Null and repeated ids and repeated rows pass through
    one to one, each row a document; other columns are not carried.  A very long text is a slab of its own.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType()),
    ])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if state.counts is None:
        state = state.insert(docs.where("false"), text_col)
    total = state.filters.agg(F.sum(F.length("slots") + F.length("passing"))).first()[0] or 0
    if total > FILTER_BYTES:
        return _by_join(state, texts, schema).withColumnRenamed("id", id_col)
    held = spark.sparkContext.broadcast([(r.shard, bytes(r.slots), bytes(r.passing)) for r in state.filters.toLocalIterator()])
    shards = state.shards

    def frequent():
        members = Members(held.value, shards)
        return lambda found, batch, slab: members.frequent(found.digest)

    return texts.mapInArrow(_kept(schema, state.least_points, frequent), schema).withColumnRenamed("id", id_col)


def _by_join(state: LineState, texts: DataFrame, schema: T.StructType) -> DataFrame:
    least_points = state.least_points
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1)):
                found = lines_of(slab, least_points)
                row = found.row[found.counted]
                keys = np.unique(np.column_stack([row, found.digest]), axis=0)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(slab.first, slab.rows).take(pa.array(keys[:, 0])), pa.array(keys[:, 1]), pa.array(keys[:, 2]),
                ], names=["digest", "h1", "h2"])

    marked = texts.withColumn("digest", digest)
    keys = marked.select("digest", "text").mapInArrow(keys_of, "digest string, h1 long, h2 long")
    often = state.counts.where(F.col("n") >= state.least_documents)
    share = (state.counts.agg(F.sum("n")).first()[0] or 0) / HOT_KEYS
    # At most HOT_KEYS keys can have that share of all counts each; the others spread in a join.
    hot, cold = often.where(F.col("n") >= share), often.where(F.col("n") < share)
    hits = keys.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_semi").unionByName(
        keys.join(cold.select("h1", "h2"), ["h1", "h2"], "left_semi"))
    of_text = hits.distinct().groupBy("digest").agg(F.collect_list(F.struct("h1", "h2")).alias("hits"))

    def frequent():
        def test(found: Lines, batch: pa.RecordBatch, slab: Slab) -> np.ndarray:
            held = {(row, h["h1"], h["h2"]) for row, some in enumerate(batch.column(2).slice(slab.first, slab.rows).to_pylist()) for h in some or ()}
            return np.array([(int(r), int(a), int(b)) in held for r, (a, b) in zip(found.row[found.counted], found.digest, strict=True)], bool)
        return test

    return marked.join(of_text, "digest", "left").select("id", "text", "hits").mapInArrow(_kept(schema, least_points, frequent), schema)
