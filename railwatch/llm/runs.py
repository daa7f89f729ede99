"""Periodic runs of words: stretches that repeat their first words several times over.

The words of each text form an enhanced suffix array.  Every LCP interval of depth ``d`` holds the
places where one sequence of ``d`` words begins.  For the suffixes of all its child intervals but the
largest, the inverse suffix array says whether the suffix ``d`` words on, or ``d`` words back, lies in
the same interval and another child.  If so, the two form a square that ends a run there (a
branching tandem repeat).  Squares rotated to the left as far as they go are the runs; multiples
of a period give the same run and are merged into it.  Intervals are ranges of the array, found by
nearest smaller values; no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import exact_numbers, joined, slabs, words
from railwatch.sources.staging import ship_package


def suffix_array(number: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of all rows together, and the common words of neighbours in it.

    Rows never share a prefix.  Ranks are doubled until every suffix stands alone.  Fewer than
    ``least`` suffixes that still agree are left in any order, and their common words are given as
    those known so far: no interval inside them has ``least`` members.
    """
    n = len(number)
    order = np.argsort(row * (int(number.max(initial=0)) + 1) + number, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = (number[order][1:] != number[order][:-1]) | (row[order][1:] != row[order][:-1])
    row_end = np.searchsorted(row, np.arange(int(row[-1]) + 2)) if n else np.zeros(1, np.int64)
    limit = row_end[row + 1] if n else row_end
    common = np.where(fresh, 0, 1)
    rank = np.empty(n, np.int64)
    heads = np.flatnonzero(fresh)
    size = np.diff(np.append(heads, n))
    rank[order] = np.repeat(heads, size)
    active = np.flatnonzero(np.repeat(size >= least, size))
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    step = 1
    while len(active):
        suffix = order[active]
        levels.append((suffix, rank[suffix]))
        next_at = suffix + step
        second = np.where(next_at < limit[suffix], rank[np.minimum(next_at, n - 1)], -1)
        group = rank[suffix]
        by = np.argsort(group * (n + 1) + second + 1)
        suffix, second, group = suffix[by], second[by], group[by]
        order[active] = suffix
        fresh = np.ones(len(active), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        split = np.flatnonzero(fresh[1:] & (group[1:] == group[:-1])) + 1
        inner = np.flatnonzero(~fresh)
        common[active[inner]] = 2 * step
        if len(split):
            common[active[split]] = step + _further(suffix[split - 1] + step, suffix[split] + step, levels[:-1], limit, n)
        heads = np.flatnonzero(fresh)
        size = np.diff(np.append(heads, len(active)))
        rank[suffix] = np.repeat(active[heads], size)
        active = active[np.repeat(size >= least, size)]
        step *= 2
    return order, common


def _further(one: np.ndarray, two: np.ndarray, levels: list, limit: np.ndarray, n: int) -> np.ndarray:
    """How many words two places share, known to be fewer than ``2 ** len(levels)``."""
    shared = np.zeros(len(one), np.int64)
    held = np.empty(n + 1, np.int64)
    for power in range(len(levels) - 1, -1, -1):
        suffix, rank = levels[power]
        held[:] = -1
        held[suffix] = rank
        # A place that ended its row is the head of the next row, or n; ranks tell rows apart.
        a, b = held[np.minimum(one, n)], held[np.minimum(two, n)]
        same = np.flatnonzero((a == b) & (a >= 0))
        shared[same] += 1 << power
        one, two = one.copy(), two.copy()
        one[same] += 1 << power
        two[same] += 1 << power
    return shared


def _nearest_smaller(value: np.ndarray) -> np.ndarray:
    """For every place the last place before it with a smaller value, by jumping along such places."""
    at = np.arange(len(value)) - 1
    open_ = np.flatnonzero(value > 0)
    open_ = open_[value[at[open_]] >= value[open_]]
    while len(open_):
        at[open_] = at[at[open_]]
        open_ = open_[value[at[open_]] >= value[open_]]
    return at


def squares(order: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """End and period of every branching square whose period also precedes it ``least - 2`` times."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    value = np.append(common, 0)
    value[0] = 0
    left = _nearest_smaller(value)
    right = n - _nearest_smaller(value[::-1])[::-1]
    border = np.flatnonzero(value > 0)
    border = border[right[border] - left[border] >= least]
    none = np.zeros(0, np.int64)
    if not len(border):
        return none, none
    # Borders of one interval side by side: they cut it into its children.
    key = left[border] * (n + 1) + right[border]
    border = border[np.argsort(key, kind="stable")]
    low, high, depth = left[border], right[border], value[border]
    first = np.ones(len(border), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    last = np.append(first[1:], True)
    heads = np.flatnonzero(first)
    interval = np.cumsum(first) - 1
    start = np.concatenate([low[heads], border])
    end = np.concatenate([border[heads], np.where(last, high, np.append(border[1:], 0))])
    of = np.concatenate([np.arange(len(heads)), interval])
    by = np.lexsort((start, of))
    start, end, of = start[by], end[by], of[by]
    child_head = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    size = end - start
    largest = np.maximum.reduceat(size, child_head)
    is_largest = size == largest[of]
    # Of several largest children only the first is left out.
    rank_of = np.cumsum(is_largest)
    before = np.repeat(rank_of[child_head] - is_largest[child_head], np.diff(np.append(child_head, len(of))))
    small = np.flatnonzero(~(is_largest & (rank_of - before == 1)))
    low, high, depth = low[heads], high[heads], depth[heads]

    found_end, found_period = [none], [none]
    # Children in pieces of bounded size: all of them together can be n log n.
    total = np.cumsum(size[small])
    cuts = np.searchsorted(total, np.arange(1, int(total[-1]) // max(n, 1) + 2) * max(n, 1), side="right") if len(total) else none
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(small)], strict=True):
        child = small[a:b]
        if not len(child):
            continue
        each = size[child]
        c = np.repeat(child, each)
        suffix = order[np.arange(len(c)) - np.repeat(np.cumsum(each) - each, each) + start[c]]
        o = of[c]
        d, lo, hi = depth[o], low[o], high[o]

        def inside(i: np.ndarray, rows: np.ndarray) -> np.ndarray:
            at = place[np.clip(i, 0, n - 1)]
            return (i >= 0) & (i < n) & (at >= lo[rows]) & (at < hi[rows])

        for shift in (1, -1):
            other = suffix + shift * d
            at = place[np.clip(other, 0, n - 1)]
            hit = (other >= 0) & (other < n) & (at >= lo) & (at < hi) & ((at < start[c]) | (at >= end[c]))
            rows = np.flatnonzero(hit)
            begin = np.minimum(suffix[rows], other[rows])
            for k in range(1, least - 1):
                on = inside(begin - k * d[rows], rows)
                rows, begin = rows[on], begin[on]
            found_end.append(begin + 2 * d[rows])
            found_period.append(d[rows])
    pair = np.unique(np.concatenate(found_end) * (n + 1) + np.concatenate(found_period))
    return pair // (n + 1), pair % (n + 1)


def _rotated(number: np.ndarray, start: int, period: int, floor: int) -> int:
    """The first place from which on every word up to ``start`` equals the one a period later."""
    width = 64
    while start > floor:
        a = max(floor, start - width)
        apart = np.flatnonzero(number[a:start] != number[a + period:start + period])
        if len(apart):
            return a + int(apart[-1]) + 1
        start, width = a, width * 2
    return start


def runs(number: np.ndarray, row: np.ndarray, least_length: int = 6, times: int = 4) -> np.ndarray:
    """Runs ``(row, start, length, period)`` ordered by all four; ``start`` counts from the row's first word.

    ``number`` are the words of all rows, one after the other, as numbers, and ``row`` ascends.  A run
    has at least ``least_length`` words and ``times`` (2 or more) periods.
    """
    if len(number) < least_length:
        return np.zeros((0, 4), np.int64)
    end, period = squares(*suffix_array(number, row, times), times)
    row_start = np.searchsorted(row, row[end - 1])
    out, settled = [], (-1, [])
    for e, d, floor in zip(end.tolist(), period.tolist(), row_start.tolist(), strict=True):
        if settled[0] != e:
            settled = (e, [])
        # A multiple of a period that reaches twice as far back says nothing new.
        if any(d % q == 0 and e - s >= 2 * d for q, s in settled[1]):
            continue
        start = _rotated(number, e - 2 * d, d, floor)
        settled[1].append((d, start))
        if e - start >= max(least_length, times * d):
            out.append((int(row[e - 1]), start - floor, e - start, d))
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, times: int = 4,
) -> DataFrame:
    """``id, n_words, runs, collapsed`` for every row of ``docs``, in one pass without a shuffle.

    A run is a stretch of words with smallest period ``q`` that no neighbour continues, of at
    least ``least_length`` words and ``times`` periods.  ``runs`` are structs ``start, length, period`` by
    start and period, ``start`` in words from 0.  ``collapsed`` holds the words that no run contains
    after its first ``q`` words, joined by one space.  Words are maximal stretches without ASCII white
    space and equal only where their bytes are.

    Null, empty and white texts have no words, no runs and an empty ``collapsed``.  Null and repeated
    ids and repeated rows pass through one to one; other columns are not carried.  A very long text
    is a slab of its own, and memory follows it: about 200 bytes a word, more by 16 bytes a word and
    doubling where most of it repeats.  An empty table gives an empty result.
    """
    if times < 2:
        raise ValueError("a run repeats at least twice")
    ship_package(docs.sparkSession)
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType()),
    ])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1)):
                start, end, row = words(slab)
                found = runs(exact_numbers(slab.data, start, end), row, least_length, times)
                count = np.bincount(row, minlength=slab.rows).astype(np.int64)
                base = (np.cumsum(count) - count)[found[:, 0]]
                cover = np.zeros(len(start) + 1, np.int64)
                np.add.at(cover, base + found[:, 1] + found[:, 3], 1)
                np.add.at(cover, base + found[:, 1] + found[:, 2], -1)
                keep = np.cumsum(cover)[:-1] == 0
                offsets = np.zeros(slab.rows + 1, np.int32)
                np.cumsum(np.bincount(found[:, 0], minlength=slab.rows), out=offsets[1:])
                parts = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(slab.first, slab.rows), pa.array(count),
                    pa.ListArray.from_arrays(pa.array(offsets), parts), joined(slab.data, start[keep], end[keep], row[keep], slab.rows, 32),
                ], names=schema.names)

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(find, schema)
    return found.withColumnRenamed("id", id_col)


def with_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with planted periods: the same rows for the same ids, for tests and the query.

    With h the CRC of the decimal id and g = h div 10, a text of n > 0 words and h mod 10 = 0
    becomes periodic from word a = g mod n on: word i is word a + (i - a) mod p, for
    p = 1 + (n - a) div (3 + g mod 8).  A null id leaves its text.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    docs = docs.withColumn("_g", F.floor(h / 10)).withColumn(
        "_words", F.when(h % 10 == 0, F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    docs = docs.withColumn("_n", F.size("_words"))
    docs = docs.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    period = F.floor((F.col("_n") - F.col("_a")) / (F.col("_g") % 8 + 3)) + 1
    docs = docs.withColumn("_p", period)
    word = F.expr("transform(sequence(0, _n - 1), i -> _words[int(if(i < _a, i, _a + (i - _a) % _p))])")
    return docs.withColumn(text_col, F.when(F.col("_a").isNotNull(), F.array_join(word, " ")).otherwise(F.col(text_col))).drop("_g", "_words", "_n", "_a", "_p")
