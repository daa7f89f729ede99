"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import Slab, list_column, lowered, mix, slabs, span_hashes, words
from railwatch.llm.linking import linked_components
from railwatch.sources.staging import discard, ship_package, staged

PERMUTATIONS = 128
BANDS = 42  # of three permutations, that is six values, each
SKETCH_DIFFERENCE = 50  # of 256 bits
SLOTS = 1 << 25
STAR = 1024

_C1, _C2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingles(slab: Slab, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every distinct shingle, ordered by row."""
    slab = Slab(slab.first, slab.last, lowered(slab.data), slab.offsets)
    start, end, row = words(slab)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = span_hashes(slab.data, start, end)
    count = np.bincount(row, minlength=slab.rows)
    last = np.cumsum(count)
    # From each word, how many words of its row follow, itself included, up to the width.
    room = np.minimum(last[row] - np.arange(len(row)), width)
    first_of_row = np.arange(len(row)) == (last - count)[row]
    begins = np.flatnonzero((room == width) | first_of_row)
    room = room[begins]
    value = mix(room.astype(np.uint64) * _C1)
    for k in range(width):
        on = room > k
        value[on] = mix(value[on] * _C2 + word[begins[on] + k])
    rows = row[begins]
    key = (rows.astype(np.uint64) << np.uint64(40)) | (value >> np.uint64(24))
    if slab.rows >= 1 << 24:
        order = np.lexsort((value, rows))
    else:
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        if (same & (value[order][1:] != value[order][:-1])).any():
            order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    fresh = np.r_[True, (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])]
    return rows[fresh], value[fresh]


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(71)
    a = rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def min_max(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each group under each permutation: one evaluation, two values."""
    low = np.empty((PERMUTATIONS, len(first)), np.uint64)
    high = np.empty_like(low)
    for k, (a, b) in enumerate(zip(*_multipliers(), strict=True)):
        permuted = value * a + b
        low[k] = np.minimum.reduceat(permuted, first)
        high[k] = np.maximum.reduceat(permuted, first)
    return low, high


def bands(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One hash a band and group."""
    each = PERMUTATIONS // BANDS
    out = np.empty((BANDS, low.shape[1]), np.uint64)
    for j in range(BANDS):
        value = np.full(low.shape[1], mix(np.array([j + 1], np.uint64))[0])
        for k in range(j * each, (j + 1) * each):
            value = mix(value * _C2 + low[k])
            value = mix(value * _C1 + high[k])
        out[j] = value
    return out


def sketch(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One bit of each signature value as four 64-bit words a group."""
    bits = np.concatenate([mix(low) & np.uint64(1), mix(high) & np.uint64(1)]).astype(np.uint8)
    return np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``id, n_shingles, print1, print2, bands, bits``: a set's size, 128-bit sum, band hashes and sketch."""
    schema = T.StructType([
        T.StructField("id", docs.schema["id"].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("print1", T.LongType()), T.StructField("print2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("bits", T.ArrayType(T.LongType())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1)):
                rows, value = shingles(slab, width)
                count = np.bincount(rows, minlength=slab.rows)
                held = np.flatnonzero(count)
                prints = np.zeros((2, slab.rows), np.uint64)
                flat = bits = np.zeros(0, np.uint64)
                if len(held):
                    first = np.r_[0, np.cumsum(count[held])[:-1]]
                    for k, c in enumerate((_C1, _C2)):
                        prints[k, held] = np.add.reduceat(mix(value ^ c), first)
                    low, high = min_max(value, first)
                    flat, bits = bands(low, high).T.ravel(), sketch(low, high).ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(slab.first, slab.rows), pa.array(count.astype(np.int64)),
                    pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                    list_column(flat.view(np.int64), np.where(count > 0, BANDS, 0), pa.int64()),
                    list_column(bits.view(np.int64), np.where(count > 0, 4, 0), pa.int64()),
                ], names=schema.names)

    return docs.mapInArrow(sign, schema)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``id, items``: the sorted shingle hashes of each document as bytes."""
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("items", T.BinaryType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1)):
                rows, value = shingles(slab, width)
                ends = np.r_[0, np.cumsum(np.bincount(rows, minlength=slab.rows))]
                items = [np.sort(value[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.rows), pa.array(items, pa.binary())], names=schema.names
                )

    return docs.mapInArrow(build, schema)


def _similar(stars: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of links, of rows ``a, part, first, id, items`` in order, the centre's rows first in each part.

    Two sets link if they share ``percent`` hundredths of their union.  Only the centre's sets are held; there
    are several where its id has several texts.
    """

    def near(x: np.ndarray, y: np.ndarray) -> bool:
        small, large = min(len(x), len(y)), max(len(x), len(y))
        if 100 * small < percent * large or not small:
            return False
        merged = np.sort(np.concatenate([x, y]))
        shared = int((merged[1:] == merged[:-1]).sum())
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centre = None, []
        for batch in batches:
            keep = []
            marks = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for mark, first, items in zip(marks, batch.column(2).to_pylist(), batch.column(4), strict=True):
                own = np.frombuffer(items.as_buffer(), np.uint64)
                if mark != star:
                    star, centre = mark, []
                if first:
                    centre.append(own.copy())
                keep.append(not first and any(near(own, c) for c in centre))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(3).filter(mask)], names=["a", "b"])

    return stars.mapInArrow(compare, "a long, b long")


def _shared(percent: int):
    """Comparison of two blocks of sets, for :func:`railwatch.llm.linking.linked_blocks`."""

    def compare(one: pa.Array, two: pa.Array) -> np.ndarray:
        sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in side] for side in (one, two)]
        sizes = [np.array([len(x) for x in side], np.float64) for side in sets]
        values = [np.concatenate([np.zeros(0, np.uint64), *side]) for side in sets]
        common = np.intersect1d(np.unique(values[0]), np.unique(values[1]))
        shared = np.zeros((len(sets[0]), len(sets[1])), np.float32)
        rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in sets]
        places = [np.searchsorted(common, v) for v in values]
        known = [(p < len(common)) & (common[np.minimum(p, max(len(common) - 1, 0))] == v if len(common) else False) for p, v in zip(places, values, strict=True)]
        # In slices of the common shingles, so that the matrices stay small.
        for at in range(0, len(common), 4096):
            parts = []
            for k in (0, 1):
                on = known[k] & (places[k] >= at) & (places[k] < at + 4096)
                matrix = np.zeros((len(sets[k]), 4096), np.float32)
                matrix[rows[k][on], places[k][on] - at] = 1
                parts.append(matrix)
            shared += parts[0] @ parts[1].T
        union = sizes[0][:, None] + sizes[1][None, :] - shared
        return (union > 0) & (100 * shared >= percent * union)

    return compare


def among(rows: DataFrame, ids: DataFrame, likely: bool = True, id_col: str = "id") -> DataFrame:
    """The rows whose id may be in ``ids`` (all that are, and few others), or else all other rows; no row is shuffled.

    A bitmap of hashed ids has ``SLOTS`` bits, four megabytes at most, so it can be broadcast whatever the number of
    ids; with very many ids more rows are likely than are in.
    """
    slot = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(SLOTS))
    own = F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(SLOTS))
    bits = ids.select(F.bitmap_bucket_number(own).alias("_bucket"), F.bitmap_bit_position(own).alias("_bit")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    marked = rows.withColumns({"_at": F.bitmap_bucket_number(slot), "_place": F.bitmap_bit_position(slot)}).join(
        F.broadcast(bits), F.col("_at") == F.col("_bucket"), "left")
    hit = F.expr("coalesce(shiftright(cast(conv(hex(substring(_bits, cast(_place div 8 AS int) + 1, 1)), 16, 10) AS int), cast(_place % 8 AS int)) & 1, 0) = 1")
    return marked.where(hit if likely else ~hit).select(*rows.columns)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id, n_shingles, component, kept`` for every row of ``docs``.

    A document's set are the distinct ``width``-word shingles of its whole lower-cased text (a
    shorter text is one shingle).  Documents link where their sets share ``percent`` hundredths of
    their union; the component is the smallest id reachable.

    128 permutations give 256 signature values, a minimum and a maximum each, in 42 bands of six: a
    pair at 0.8 meets in some band with probability 1 - (1 - 0.8**6)**42 > 0.999997.  Candidates whose
    one-bit sketches differ in over 50 of 256 places are left out (a pair at 0.8 differs in 26 on
    average, with a deviation of 5, so one in some millions is missed).  Equal sets are joined before
    by a 128-bit sum and enter as one.  All other candidates are compared on their full sets.  Both
    figures are for ``percent`` = 80; a lower one needs other bands.

    Null and empty texts, and texts of white space, have no shingle and link with nothing.  Rows
    with a null id are returned with a null component and are not kept.  Rows that repeat an id
    are all returned; where their texts differ, each row has the component of its own text, and all texts of the id are
    compared.  Other columns are not carried.  An empty table gives an empty
    result.  Ids are integers.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = staged(signatures(texts, width), "signatures")
    prints = ["print1", "print2", "n_shingles"]
    sets = staged(
        signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy(*prints).agg(F.min("id").alias("rep")), "sets"
    )
    lead = signed.where("n_shingles > 0").join(sets.withColumnRenamed("rep", "id").hint("merge"), [*prints, "id"], "left_semi")
    if not signed.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        lead = lead.dropDuplicates([*prints, "id"])
    leading = staged(lead.select("id", "n_shingles", "bands", *[F.get("bits", F.lit(k)).alias(f"w{k}") for k in range(4)]), "leading")
    spent = [leading]
    # The band is part of the bucket, so a document's own buckets differ.
    members = leading.select("id", F.posexplode("bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("bucket"), "id"
    )
    traits = leading.select("id", "n_shingles", "w0", "w1", "w2", "w3")

    def plausible(x: str, y: str):
        apart = sum((F.bit_count(F.col(f"{x}w{k}").bitwiseXOR(F.col(f"{y}w{k}"))) for k in range(4)), F.lit(0))
        small, large = F.least(f"{x}n_shingles", f"{y}n_shingles"), F.greatest(f"{x}n_shingles", f"{y}n_shingles")
        return (100 * small >= percent * large) & (apart <= SKETCH_DIFFERENCE)

    def sets_of(ids: DataFrame) -> DataFrame:
        # The exact join stands behind the sets: before them it would shuffle every text.
        return shingle_sets(among(texts, ids), width).join(ids, "id", "left_semi")

    def verify(pairs: DataFrame) -> DataFrame:
        parts = F.ceil(F.col("k") / STAR).cast("int")
        sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("k"))
        rays = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"), F.lit(False).alias("first"), F.col("b").alias("id"))
        centres = sizes.select("a", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(True).alias("first"), F.col("a").alias("id"))
        wanted = staged(centres.union(rays), "wanted")
        spent.append(wanted)
        known = shingle_sets(among(texts, wanted.select("id")), width)
        dealt = known.join(wanted.hint("merge"), "id").select("a", "part", "first", "id", "items").repartition("a", "part")
        return _similar(dealt.sortWithinPartitions("a", "part", F.desc("first")), percent)

    groups = linked_components(members, verify, sets_of, _shared(percent), traits, plausible)
    discard(*spent)
    placed = sets.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select(
        *[F.col(c).alias(f"_{c}") for c in prints], F.coalesce("component", "rep").alias("_component")
    )
    same = (signed.print1 == F.col("_print1")) & (signed.print2 == F.col("_print2")) & (signed.n_shingles == F.col("_n_shingles"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    return signed.drop("bands").join(placed, same, "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near duplicates, with all their columns.

    The one with the smallest id stays.  Rows with a null id stay; of rows that repeat an id one
    stays.
    """
    id_col = options.get("id_col", "doc_id")
    found = staged(near_duplicates(docs, **options), "near-duplicates")
    dropped = found.where(F.col(id_col).isNotNull() & ~F.col("kept")).select(id_col).distinct()
    # Only texts that may have to go meet the ids in a join.
    ids = dropped.withColumnRenamed(id_col, "id") if id_col != "id" else dropped
    doubted = among(docs, ids, id_col=id_col).join(dropped.hint("merge"), id_col, "left_anti").select(*docs.columns)
    left = among(docs, ids, likely=False, id_col=id_col).unionByName(doubted)
    repeated = found.where("kept").groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col)
    if repeated.isEmpty():
        return left
    several = left.join(repeated, id_col, "left_semi").select(*docs.columns)
    return left.join(repeated, id_col, "left_anti").select(*docs.columns).unionByName(several.dropDuplicates([id_col]))
