"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import Slab, slabs, span_hashes, words
from railwatch.sources.staging import ship_package

LINE_FEATURES = 16
FIT_DOCUMENTS = 4_000
FIT_LINES = 200
FIT_STEPS = 160
PENALTY = 1e-3


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)


_BYTE = np.arange(256)
_UPPER, _DIGIT = (_BYTE >= 65) & (_BYTE <= 90), (_BYTE >= 48) & (_BYTE <= 57)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 0xC0)
_PLAIN_MARK = np.isin(_BYTE, list(b".,;:'\"()-?"))
_SPACE = np.isin(_BYTE, [32, 9, 10, 11, 12, 13])
_SYMBOL = (_BYTE > 32) & (_BYTE < 127) & ~_UPPER & ~_DIGIT & ~((_BYTE >= 97) & (_BYTE <= 122)) & ~_PLAIN_MARK


def line_features(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lines of every text, each line's length in bytes, and its features.

    An empty text has one empty line.  The features of a line are shares (capitals, digits, symbols,
    bars, exclamation marks, words that end in a symbol, words equal to the word before, words seen
    often in the line), lengths, and whether the same line occurs again in the text.
    """
    data, n = slab.data, len(slab.data)
    breaks = np.flatnonzero(data == 10)
    row_of_break = np.searchsorted(slab.offsets, breaks, side="right") - 1
    lines = 1 + np.bincount(row_of_break, minlength=slab.rows)
    # A line runs from the start of its text or the byte after a break; a break stays in its line.
    first = np.cumsum(lines) - lines
    start = np.empty(lines.sum(), np.int64)
    start[first] = slab.offsets[:-1]
    inner = np.ones(len(start), bool)
    inner[first] = False
    start[inner] = breaks + 1
    bounds = np.append(start, n)
    size = np.diff(bounds).astype(np.float64)
    letters = _sums(_LETTER[data], bounds)
    # Capitals of the two-byte Latin range count as capitals too.
    latin = np.zeros(n, bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    upper = _sums(_UPPER[data] | latin, bounds)
    per_byte = lambda flags: _sums(flags[data], bounds) / np.maximum(size, 1)
    w_start, w_end, _ = words(slab)
    w_line = np.searchsorted(start, w_start, side="right") - 1
    count = np.bincount(w_line, minlength=len(start)).astype(np.float64)
    w_hash = span_hashes(data, w_start, w_end)
    repeat = np.zeros(len(w_hash), bool)
    repeat[1:] = (w_hash[1:] == w_hash[:-1]) & (w_line[1:] == w_line[:-1])
    again = np.zeros(len(w_hash), bool)
    key = w_hash ^ (w_line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    again[order[1:]] = key[order][1:] == key[order][:-1]
    last = _SYMBOL[data[w_end - 1]] if len(w_end) else np.zeros(0, bool)
    per_word = lambda flags: np.bincount(w_line, weights=flags, minlength=len(start)) / np.maximum(count, 1)
    line_end = np.maximum(np.append(start[1:], n) - 1, start)
    trimmed_end = np.where((size > 0) & (data[np.minimum(line_end, n - 1)] == 10), line_end, np.append(start[1:], n)) if n else start
    line_hash = span_hashes(data, start, np.maximum(trimmed_end, start))
    row = np.repeat(np.arange(slab.rows), lines)
    line_key = line_hash ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, inverse, times = np.unique(line_key, return_inverse=True, return_counts=True)
    ends_plain = np.zeros(len(start))
    if n:
        tail = np.maximum(trimmed_end - 1, 0)
        ends_plain = ((trimmed_end > start) & np.isin(data[tail], list(b".?!"))).astype(np.float64)
    features = np.stack([
        np.log1p(size) / 6, np.log1p(count) / 4, upper / np.maximum(letters, 1), per_byte(_DIGIT), per_byte(_SYMBOL),
        per_word(data[w_start] == ord("|")) if n else np.zeros(len(start)),
        _sums(data == ord("!"), bounds) / np.maximum(count, 1), per_word(last), per_word(repeat), per_word(again),
        np.log1p((size - count) / np.maximum(count, 1)) / 2, (times[inverse] > 1).astype(np.float64), ends_plain,
        (size < 2).astype(np.float64), per_byte(_SPACE), letters / np.maximum(size, 1),
    ], axis=1)
    return lines, size, features


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it, and whether it is first or last."""
    first = np.cumsum(lines) - lines
    is_first, is_last = np.zeros(len(features)), np.zeros(len(features))
    is_first[first], is_last[first + lines - 1] = 1, 1
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[is_first == 1], after[is_last == 1] = 0, 0
    return np.hstack([features, before, after, is_first[:, None], is_last[:, None], np.ones((len(features), 1))])


@dataclass(frozen=True)
class Model:
    """``weights`` of label 1 against label 0, and log potentials ``step[from, to]``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    step: np.ndarray

    def evidence(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return with_neighbours((features - self.mean) / self.scale, lines) @ self.weights

    def marginals(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every line."""
        return _forward_backward(self.evidence(features, lines), lines, self.step)[0]


def _forward_backward(evidence: np.ndarray, lines: np.ndarray, step: np.ndarray):
    """Marginals of all lines, expected transitions, and the log partition of every text.

    Texts are stepped together, those with more lines longer.
    """
    order = np.argsort(-lines, kind="stable")
    first = (np.cumsum(lines) - lines)[order]
    count = lines[order]
    longest = int(count[0]) if len(count) else 0
    alive = np.searchsorted(-count, -np.arange(1, longest + 1), side="right")  # texts with more than t lines
    forward = np.zeros((len(evidence), 2))
    for t in range(longest):
        at = first[:alive[t]] + t
        own = np.stack([np.zeros(len(at)), evidence[at]], axis=1)
        if t:
            forward[at] = np.logaddexp(forward[at - 1][:, :1] + step[0], forward[at - 1][:, 1:] + step[1]) + own
        else:
            forward[at] = own
    backward = np.zeros((len(evidence), 2))
    last = first + count - 1
    total = np.logaddexp(forward[last, 0], forward[last, 1])
    moves = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[:alive[t + 1]] + t
        onward = backward[at + 1] + np.stack([np.zeros(len(at)), evidence[at + 1]], axis=1)
        backward[at] = np.logaddexp(step[:, 0] + onward[:, :1], step[:, 1] + onward[:, 1:])
        pair = forward[at][:, :, None] + step[None] + onward[:, None, :] - total[:alive[t + 1], None, None]
        moves += np.exp(pair).sum(axis=0)
    norm = np.empty(len(evidence))
    norm[np.repeat(first, count) + np.arange(len(evidence)) - np.repeat(np.cumsum(count) - count, count)] = np.repeat(total, count)
    return np.exp(forward[:, 1] + backward[:, 1] - norm), moves, total


def fit(features: np.ndarray, lines: np.ndarray, label: np.ndarray) -> Model:
    """Maximum likelihood of the label sequences, all lines of a text having its label, with a penalty."""
    width = 3 * LINE_FEATURES + 3
    if not len(lines):
        return Model(np.zeros(LINE_FEATURES), np.ones(LINE_FEATURES), np.zeros(width), np.zeros((2, 2)))
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    x = with_neighbours((features - mean) / scale, lines)
    y = np.repeat(label, lines).astype(np.float64)
    seen = np.zeros((2, 2))
    for value in (0, 1):
        seen[value, value] = (lines[label == value] - 1).sum()
    weights, step = np.zeros(width), np.zeros((2, 2))
    slope = [np.zeros(width), np.zeros((2, 2))]
    square = [np.zeros(width), np.zeros((2, 2))]
    for turn in range(1, FIT_STEPS + 1):
        probability, moves, _ = _forward_backward(x @ weights, lines, step)
        grads = [x.T @ (y - probability) / len(lines) - PENALTY * weights, (seen - moves) / len(lines) - PENALTY * step]
        rate = 0.15 / (1 + turn / 60)
        for k, (value, grad) in enumerate(zip((weights, step), grads, strict=True)):
            slope[k] = 0.9 * slope[k] + 0.1 * grad
            square[k] = 0.99 * square[k] + 0.01 * grad * grad
            value += rate * (slope[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-8)
    return Model(mean, scale, weights, step)


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS, max_lines: int = FIT_LINES,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Fit on a bounded sample: the first ``documents`` labelled ones in the order of a hash of the id.

    Held-out documents are left out, and sampled ones of over ``max_lines`` lines, so the driver gets
    at most ``documents * max_lines`` short rows.  A label other than 0 and 1 and a null are no label;
    of several labels of one id the least counts.
    """
    ship_package(docs.sparkSession)
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("_id")
    ).agg(F.min(label_col).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(documents)
    # Bounded by ``documents`` rows of two numbers.
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id").select("_id", "_label", "_text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(2)):
                lines, _, features = line_features(slab)
                ends = np.r_[0, np.cumsum(lines)]
                keep = np.flatnonzero(lines <= max_lines)
                rows = [features[ends[i]:ends[i + 1]].astype(np.float32).tobytes() for i in keep]
                at = pa.array(keep + slab.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(rows, pa.binary())], names=["id", "label", "lines"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    found = chosen.mapInArrow(describe, f"id {kind}, label int, lines binary").collect()
    # Repeated ids beyond the bound would come from repeated rows; the order makes the fit repeatable.
    found = sorted(found, key=lambda r: (str(r.id), bytes(r.lines)))[:documents]
    parts = [np.frombuffer(r.lines, np.float32).reshape(-1, LINE_FEATURES).astype(np.float64) for r in found]
    features = np.concatenate(parts) if parts else np.zeros((0, LINE_FEATURES))
    return fit(features, np.array([len(p) for p in parts], np.int64), np.array([r.label for r in found], np.int64))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score``: the mean of a text's line marginals, weighted by length, for every row.

    Null and empty texts are one empty line, scored as such.  Null ids and repeated rows are scored
    each.  Whole texts are read, however long.  Other columns are not carried.  An empty table gives
    an empty result.
    """
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1)):
                value = document_scores(slab, model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.rows), pa.array(value)], names=["id", "score"]
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, schema).withColumnRenamed("id", id_col)


def document_scores(slab: Slab, model: Model) -> np.ndarray:
    lines, size, features = line_features(slab)
    good = model.marginals(features.astype(np.float32).astype(np.float64), lines)
    row = np.repeat(np.arange(slab.rows), lines)
    weight = size + 1
    value = np.bincount(row, weights=good * weight, minlength=slab.rows) / np.bincount(row, weights=weight, minlength=slab.rows)
    return np.clip(value, 0.0, 1.0)


def good_documents(docs: DataFrame, model: Model, at_least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``at_least``, with all their columns, in one pass."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [document_scores(slab, model) for slab in slabs(batch.column(place))]
            if value:
                yield batch.filter(pa.array(np.concatenate(value) >= at_least))

    return docs.mapInArrow(keep, docs.schema)
