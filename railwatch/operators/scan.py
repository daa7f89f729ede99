"""Ordered running values that never put a whole key into one task.

A plain ``partitionBy(key).orderBy(seq)`` window sends every row of a key to one task.
Here the order column is cut into buckets: rows are scanned inside their bucket, bucket
totals are scanned one level up, and the carry is joined back on ``(key, bucket)``.  With
the default widths a task scans at most 8,192 rows of a dense sequence, and the totals
shrink by that factor per level, so a key with a third of all rows spreads evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHIFTS = (16,)


def _over(kind: str, col: Column, window) -> Column:
    if kind == "sum":
        return F.sum(col).over(window)
    if kind == "max":
        return F.max(col).over(window)
    if kind == "last":
        return F.last(col, ignorenulls=True).over(window)
    raise ValueError(kind)


def _total(kind: str, col: Column, order: Column) -> Column:
    if kind == "sum":
        return F.sum(col)
    if kind == "max":
        return F.max(col)
    return F.max_by(col, F.when(col.isNotNull(), order))


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.when(
            carry.isNotNull() | local.isNotNull(),
            F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)),
        )
    if kind == "max":
        return F.greatest(carry, local)
    return F.coalesce(local, carry)


def running(
    df: DataFrame,
    order: str,
    values: dict[str, tuple[str, str]],
    keys: Sequence[str] = (),
    inclusive: bool = True,
    shifts: Sequence[int] = SHIFTS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add running values: ``{out: (kind, column)}``, kind in ``sum``, ``max``, ``last``.

    ``order`` is a non-null integer; rows of equal ``order`` are placed by ``ties``.
    ``keys`` are non-null.
    ``last`` carries the latest non-null value forward.  ``inclusive=False`` looks at
    earlier rows only.
    """
    end = 0 if inclusive else -1
    if not shifts:
        # Top level: one row per key and widest bucket.
        window = Window.partitionBy(*keys).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumns({out: _over(k, F.col(c), window) for out, (k, c) in values.items()})

    bucket = f"__bucket{len(shifts)}"
    cut = df.withColumn(bucket, F.shiftright(F.col(order).cast("long"), shifts[0]))
    place = F.struct(order, *ties) if ties else F.col(order)
    totals = cut.groupBy(*keys, bucket).agg(
        *[_total(k, F.col(c), place).alias(f"__t_{out}") for out, (k, c) in values.items()]
    )
    carried = running(
        totals, bucket, {f"__c_{out}": (k, f"__t_{out}") for out, (k, _) in values.items()},
        keys, inclusive=False, shifts=shifts[1:],
    ).select(*keys, bucket, *[f"__c_{out}" for out in values])

    window = (
        Window.partitionBy(*keys, bucket).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, end)
    )
    local = cut.withColumns({f"__l_{out}": _over(k, F.col(c), window) for out, (k, c) in values.items()})
    joined = local.join(carried, [*keys, bucket], "left")
    return joined.select(
        *df.columns,
        *[
            _combine(k, F.col(f"__c_{out}"), F.col(f"__l_{out}")).alias(out)
            for out, (k, _) in values.items()
        ],
    )


def in_time_blocks(df: DataFrame, time: str, within_ms: int, width_ms: int = 1 << 18) -> DataFrame:
    """Cut the time of a key into blocks in which every row sees the ``within_ms`` before it.

    Adds ``__block`` and ``__own``.  A block is at least ``within_ms`` wide; rows at its end are there twice, the
    copies (``__own`` false) in the next block.  What looks back no further can be computed inside ``(key, __block)`` with
    ordinary windows, all of them behind one exchange, and a busy key is spread over its blocks.
    """
    width = max(within_ms, width_ms)
    block = F.floor(F.col(time) / F.lit(width)).cast("long")
    near_end = F.pmod(F.col(time), F.lit(width)) >= width - within_ms
    blocks = F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))
    return df.select("*", F.posexplode(blocks).alias("__copy", "__block")).withColumn("__own", F.col("__copy") == 0).drop("__copy")
