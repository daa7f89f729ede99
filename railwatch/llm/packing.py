"""Pack token sequences: best fit, then a swap-based local search that empties bins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import list_column, slabs
from railwatch.sources.staging import ship_package, staged

BLOCK_ROWS = 16_384


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """Bin of each length by best fit in falling order; the open bins are found by a bit per free size."""
    free_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    mask, bins = 0, 0
    out = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = mask >> size
        if fitting:
            free = size + ((fitting & -fitting).bit_length() - 1)
            at = free_bins[free].pop()
            if not free_bins[free]:
                mask &= ~(1 << free)
        else:
            at, free, bins = bins, limit, bins + 1
        out[i] = at
        free -= size
        if free:
            free_bins[free].append(at)
            mask |= 1 << free
    return out, bins


def empty_bins(lengths: np.ndarray, at: np.ndarray, bins: int, limit: int) -> np.ndarray:
    """Improve a packing: take the emptiest bin and press its pieces into fuller ones.

    A piece leaves by a move into free room, by an exchange with one shorter piece of a fuller bin,
    or by an exchange with any two.  Each of the three raises the sum of squared fills, as room passes
    from a fuller to an emptier bin, so passes end: after one over all bins that moves nothing, or when
    the free room of all bins together is less than one bin.
    """
    at = at.copy()
    fill = np.bincount(at, weights=lengths, minlength=bins).astype(np.int64)
    moved = True
    while moved:
        tried, failed, moved = np.zeros(bins, bool), False, False
        while True:
            candidates = np.flatnonzero((fill > 0) & (fill < limit) & ~tried)
            if not len(candidates):
                break
            donor = int(candidates[np.argmin(fill[candidates])])
            tried[donor] = True
            if not failed and limit * int((fill > 0).sum()) - int(lengths.sum()) < limit:
                return at  # the free room of all bins together is less than one bin
            moved |= _press(donor, lengths, at, fill, limit)
            failed = fill[donor] > 0
    return at


def _press(donor: int, lengths: np.ndarray, at: np.ndarray, fill: np.ndarray, limit: int) -> bool:
    """Move what can be moved out of a bin; whether anything was."""
    moved = False
    while fill[donor]:
        changed = False
        pieces = np.flatnonzero(at == donor)
        for i in pieces[np.argsort(-lengths[pieces], kind="stable")].tolist():
            size = int(lengths[i])
            # Only fuller bins take: that raises the sum of squares.
            room = np.where(fill >= fill[donor], limit - fill, -1)
            room[donor] = -1
            fits = np.where((room >= size) & (fill > 0), room, limit + 1)
            best = int(np.argmin(fits))
            if fits[best] <= limit:
                at[i], changed = best, True
                fill[best] += size
                fill[donor] -= size
                continue
            # One for one: the shorter piece that leaves the other bin fullest.
            own = room[at]
            good = (own >= 0) & (lengths < size) & (lengths + own >= size)
            if good.any():
                left = np.where(good, own + lengths - size, limit + 1)
                least = left.min()
                # Of equally good ones the shortest comes back.
                j = int(np.argmin(np.where(left == least, lengths, limit + 1)))
                other = int(at[j])
                at[i], at[j], changed = other, donor, True
                fill[other] += size - lengths[j]
                fill[donor] -= size - lengths[j]
                continue
            # Two for one: each piece of a bin with the shortest other one of it that makes enough room.
            a = np.flatnonzero((own >= 0) & (lengths < size))
            keys = at[a] * (limit + 1) + lengths[a]
            order = np.argsort(keys, kind="stable")
            a, keys = a[order], keys[order]
            need = np.maximum(size - room[at[a]] - lengths[a], 0)
            to = np.searchsorted(keys, at[a] * (limit + 1) + need)
            to += to == np.arange(len(a))
            b = a[np.minimum(to, len(a) - 1)]
            both = lengths[a] + lengths[b]
            good = (to < len(a)) & (at[a] == at[b]) & (both < size)
            if good.any():
                k = int(np.argmin(np.where(good, room[at[a]] + both - size, limit + 1)))
                other = int(at[a[k]])
                at[i], changed = other, True
                at[a[k]] = at[b[k]] = donor
                fill[other] += size - both[k]
                fill[donor] -= size - both[k]
        if not changed:
            break
        moved = True
    return moved


def pack_block(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    at, bins = best_fit(lengths, limit)
    at = empty_bins(lengths, at, bins, limit)
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.r_[True, at[order][1:] != at[order][:-1]]
    base = np.maximum.accumulate(np.where(first, ends - lengths[order], 0))
    offset = np.empty(len(lengths), np.int64)
    offset[order] = ends - lengths[order] - base
    return at.astype(np.int64), offset, int(at.max()) + 1


def pieces(
    docs: DataFrame, vocabulary: str, limit: int, end_id: int, id_col: str, text_col: str, keep_ids: bool,
) -> DataFrame:
    """``id, n_ids, checks`` (and ``ids``) of every document: its ids cut from the end into whole pieces."""
    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_ids", T.LongType()),
              T.StructField("checks", T.ArrayType(T.LongType()))]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from railwatch.llm.bpe import checksum, encoder

        machine = encoder(vocabulary, True)
        for batch in batches:
            for slab in slabs(batch.column(1)):
                counts, flat = machine.ids(slab)
                ends = np.cumsum(counts)
                whole = np.insert(flat, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                checks, parts = [], []
                for start, end in zip(ends - counts - 1, ends, strict=True):
                    cut = [start, *range(int(start + ((end - start - 1) % limit + 1)), int(end) + 1, limit)]
                    checks += [checksum(whole[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                    parts.append(len(cut) - 1)
                columns = [
                    batch.column(0).slice(slab.first, slab.rows), pa.array(counts + 1),
                    list_column(np.array(checks, np.int64), np.array(parts), pa.int64()),
                ]
                if keep_ids:
                    columns.append(list_column(whole.astype(np.int64), counts + 1, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, T.StructType(fields))


def pack(
    docs: DataFrame, vocabulary: str, limit: int = 1024, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """``id, piece, start, length, check, sequence_id, offset`` (and ``ids``), one row a piece.

    A document longer than ``limit`` ids is cut so that only its first piece may be shorter; whole
    pieces fill a sequence alone, the others are packed.  Rows of (id, number of ids) are dealt
    evenly into blocks of about ``BLOCK_ROWS`` and each block is packed in one task; texts are read
    once and never shuffled.  ``check`` is the CRC-32 of the piece's ids as little-endian words.

    Null and empty texts are the end id alone.  Null ids, repeated ids and repeated rows are packed
    each.  A very long text yields many whole pieces and one other.  Other columns are not carried.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    encoded = staged(pieces(docs, vocabulary, limit, end_id, id_col, text_col, keep_ids), "pack-pieces")
    blocks = max(1, -(-encoded.count() // BLOCK_ROWS))
    ids = ", ids array<long>" if keep_ids else ""
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        from pyspark import TaskContext

        table = pa.Table.from_batches(rows).combine_chunks()
        base = TaskContext.get().partitionId() << 40
        n = table.column("n_ids").to_numpy()
        first = (n - 1) % limit + 1
        part = first < limit
        at, offset, bins = pack_block(first[part], limit)
        sequence, place_in = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        sequence[part], place_in[part] = at, offset
        count = (n - first) // limit + 1
        alone = count - part
        next_free = bins + np.cumsum(alone) - alone
        row = np.repeat(np.arange(len(n)), count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        head = number == 0
        start = np.where(head, 0, first[row] + (number - 1) * limit)
        length = np.where(head, first[row], limit)
        packed = head & part[row]
        columns = {
            "id": table.column("id").combine_chunks().take(pa.array(row)), "piece": pa.array(number, pa.int32()), "start": pa.array(start),
            "length": pa.array(length), "check": pc.list_flatten(table.column("checks")).combine_chunks(),
            "sequence_id": pa.array(base + np.where(packed, sequence[row], next_free[row] + number - part[row])),
            "offset": pa.array(np.where(packed, place_in[row], 0)),
        }
        if keep_ids:
            columns["ids"] = list_column(pc.list_flatten(table.column("ids")).to_numpy(), length, pa.int64())
        yield from pa.table(columns).to_batches(20_000)

    placed = encoded.repartition(blocks).mapInArrow(
        place, f"id {kind}, piece int, start long, length long, `check` long, sequence_id long, offset long{ids}"
    )
    return placed.withColumnRenamed("id", id_col)
