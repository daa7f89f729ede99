"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.sources.staging import staged

PRIME = 2_147_483_647
ROUNDS = 6
WALK = 64


def row_numbers(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Number all rows from 0 in the order of ``order``, without one task that sees them all.

    Rows are dealt by ranges of ``order`` and sorted inside their range; a range's first number is
    the number of rows in the ranges before it.  Rows equal in ``order`` are dealt by their place
    in the input, so that a value held by very many rows does not fill one range; which of them
    gets which number is arbitrary.
    """
    spark = df.sparkSession
    wide = df.withColumn("_tie", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(
        wide.repartitionByRange(parts, *[F.col(c) for c in order], F.col("_tie"))
        .withColumn("_part", F.spark_partition_id()), "rows",
    )
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_part").orderBy(*[F.col(c) for c in order], F.col("_tie"))
    return (
        dealt.join(first, "_part").withColumn(name, F.col("_first") + F.row_number().over(inside) - 1)
        .drop("_part", "_first", "_tie")
    )


def _round(value: Column, key: int) -> Column:
    x = (value + key) % PRIME
    return ((x * x) % PRIME * 16807 + key) % PRIME


def round_keys(seed: int) -> list[int]:
    """Keys of the rounds: a multiplicative congruence from the seed."""
    keys, state = [], seed % (PRIME - 1) + 1
    for _ in range(ROUNDS):
        state = state * 48271 % PRIME
        keys.append(state)
    return keys


def permuted(row: Column, rows: int, seed: int) -> Column:
    """A permutation of ``0 .. rows - 1`` as a column expression.

    The number is written as ``left * b + right`` with ``a * b`` just over ``rows``; each round adds
    a keyed function of one half to the other, which can always be undone.  A result outside
    ``0 .. rows - 1`` is permuted again (cycle walking): at most ``a`` numbers are outside, so one
    step stays outside with a chance below ``1 / sqrt(rows)``.
    """
    a = max(1, int(rows**0.5))
    b = max(1, -(-rows // a))

    def step(value: Column) -> Column:
        halves = F.array(F.floor(value / b).cast("long"), value % b)
        keys = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(i % 2).alias("side")) for i, k in enumerate(round_keys(seed))])

        def turn(pair: Column, key: Column) -> Column:
            left, right = pair[0], pair[1]
            return F.when(key["side"] == 0, F.array((left + _round(right, key["k"])) % a, right)).otherwise(
                F.array(left, (right + _round(left, key["k"])) % b)
            )

        return F.aggregate(keys, halves, turn, lambda pair: pair[0] * b + pair[1])

    once = step(row)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once, lambda value, _: F.when(value < rows, value).otherwise(step(value)),
        lambda value: F.when(value < rows, value).otherwise(F.raise_error(F.lit("cycle walk did not end"))),
    )
    return walked


def shard(docs: DataFrame, shards: int, seed: int = 20240229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot``: every row's place in a shuffled order dealt in turn.

    Numbers are given in the order of (id, checksum, size), permuted, and dealt round: the counts of
    shards differ by one at most, slots are gapless from 0, and a run over the same rows gives the
    same places however the input is partitioned.

    A null text has size 16 and the checksum of an empty one.  Null ids come first.  Repeated rows
    get places of their own; which of several equal rows gets which is of no effect.  Other columns
    are not carried.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    numbered = row_numbers(sized, [id_col, "text_crc32", "size"])
    rows = docs.count()
    place = permuted(F.col("row"), max(rows, 1), seed)
    return numbered.withColumn("_place", place).select(
        id_col, "size", "text_crc32", (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
    )
