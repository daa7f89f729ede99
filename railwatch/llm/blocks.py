"""Columns of Arrow batches as flat numpy arrays, in slabs of bounded size.

Operators that read whole texts work on the UTF-8 bytes of many rows at once.  A slab holds at
most ``SLAB_BYTES`` of text, or one longer text, so memory follows the longest text and not the
size of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 20

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):  # another C library keeps its own rules
    _libc = None

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TAIL = np.array([(1 << 64) - 1] + [(1 << 8 * k) - 1 for k in range(1, 8)], np.uint64)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on as one number, zeros behind the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))


def _steps(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lanes of every span, and span and place of every lane behind a span's first."""
    each = np.maximum((length + 7) >> 3, 1)
    long = np.flatnonzero(each > 1)
    more = each[long] - 1
    span = np.repeat(long, more)
    return each, span, np.arange(len(span)) - np.repeat(np.cumsum(more) - more, more) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[start:end]`` for every span.

    Eight bytes at a time go through a mixer that also takes their place, so no family of strings
    collides by its form.  Where identity must be exact, :func:`same_spans` compares the bytes.
    """
    length = end - start
    lanes = _lanes(data)
    each, span, place = _steps(length)
    tail = _TAIL[length & 7]
    first = lanes[start]
    short = each == 1
    first[short] &= tail[short]
    first[length == 0] = 0
    total = mix(first ^ np.uint64(0xC2B2AE3D27D4EB4F))
    if len(span):
        value = lanes[start[span] + 8 * place]
        at_end = place == each[span] - 1
        value[at_end] &= tail[span[at_end]]
        value = mix(value ^ mix(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        fresh = np.flatnonzero(place == 1)
        total[span[fresh]] += np.add.reduceat(value, fresh)
    return mix(total + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def same_spans(one: np.ndarray, at_one: np.ndarray, two: np.ndarray, at_two: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` bytes of ``one`` and of ``two`` agree, for every pair of places."""
    x, y = _lanes(one), _lanes(two)
    each, span, place = _steps(length)
    tail = _TAIL[length & 7]
    apart = x[at_one] ^ y[at_two]
    short = each == 1
    apart[short] &= tail[short]
    same = (apart == 0) | (length == 0)
    if len(span):
        apart = x[at_one[span] + 8 * place] ^ y[at_two[span] + 8 * place]
        at_end = place == each[span] - 1
        apart[at_end] &= tail[span[at_end]]
        same[span[apart != 0]] = False
    return same


def exact_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for every span, equal where and only where the bytes are equal.

    Spans are put together by their hashes and compared byte by byte with the first of their hash;
    those that differ from it are told apart by a table of their bytes.
    """
    if not len(start):
        return np.zeros(0, np.int64)
    length = end - start
    _, first, number = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    lead = first[number]
    same = length == length[lead]
    check = np.flatnonzero(same & (lead != np.arange(len(start))))
    same[check] = same_spans(data, start[check], data, start[lead[check]], length[check])
    known: dict[bytes, int] = {}
    for k in np.flatnonzero(~same):
        number[k] = known.setdefault(data[start[k]:end[k]].tobytes(), len(first) + len(known))
    return number.astype(np.int64)


@dataclass
class Slab:
    """Rows ``first`` to ``last`` of a batch: their bytes and ``len(rows) + 1`` offsets."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()

    @property
    def rows(self) -> int:
        return self.last - self.first


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """Cut a string column into slabs; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    # Read in place: a null takes no bytes of its own.
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if column.null_count and (np.diff(offsets)[np.asarray(column.is_null())] > 0).any():
        column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slab(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last
    release()


def release() -> None:
    """Give memory that batches have freed back to the system; workers live on between stages."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run without ASCII white space; runs end with their row."""
    n = len(slab.data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_IS_SPACE[slab.data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    # A run that crosses a row border is cut there.
    cuts = slab.offsets[1:-1]
    if len(cuts):
        cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
        cuts = cuts[inside[cuts] & inside[cuts + 1]] if len(cuts) else cuts
        if len(cuts):
            start = np.sort(np.concatenate([start, cuts]))
            end = np.sort(np.concatenate([end, cuts]))
    row = np.searchsorted(slab.offsets, start, side="right") - 1
    return start, end, row


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, every other byte as it is."""
    return _LOWER[data]


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int, mark: int) -> pa.Array:
    """The spans of every row, in order, with the byte ``mark`` between two; ``row`` ascends."""
    length = end - start + 1
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    out_end = np.cumsum(length)
    total = int(out_end[-1]) if len(length) else 0
    at = np.repeat(start - (out_end - length), length) + np.arange(total)
    text = data[np.minimum(at, len(data) - 1)] if len(data) else np.zeros(total, np.uint8)
    text[out_end - 1] = mark
    whole = np.ones(total, bool)
    whole[out_end[last] - 1] = False
    offsets = np.zeros(rows + 1, np.int32)
    np.cumsum(np.bincount(row, weights=length - last, minlength=rows).astype(np.int64), out=offsets[1:])
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(text[whole]))
