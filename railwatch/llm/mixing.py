"""Mix sources to target weights by hash thresholds found in nested histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.sources.staging import staged

HASH_BITS = 60
LEVEL_BITS = 12
WORDS = "[^\\x20\\x09-\\x0D]+"


def place(key: Column) -> Column:
    """A row's fixed point in ``0 .. 2**60 - 1``: the first 15 hexadecimal digits of an MD5."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``source, source_size, target``: one row a source, in the order of code points, null last.

    Weights repeat along that order.  A target that would exceed ``most`` times its source stops
    there and the rest is shared again by weight: with sources ordered by (limit / weight), the
    level is that of the first source which it does not fill.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((ordered - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    filled = Window.orderBy("_ratio", "_order").rowsBetween(Window.unboundedPreceding, -1)
    table = sources.withColumn("_order", ordered).withColumn("_w", weight).withColumn(
        "_cap", (F.col("source_size") * most).cast("double")
    ).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    table = table.withColumn(
        "_level",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_cap").over(filled), F.lit(0.0)))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(filled), F.lit(0.0))),
    )
    fits = F.col("_level") * F.col("_w") <= F.col("_cap")
    found = F.min(F.when(fits, F.struct("_ratio", "_order", "_level"))).over(everything)
    return table.withColumn("_found", found["_level"]).select(
        "source", "source_size",
        F.least(F.col("_cap"), F.coalesce(F.col("_found") * F.col("_w"), F.col("_cap"))).alias("target"),
    )


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``whole`` (copies that every document gets) and ``upto`` (the last point that gets one more).

    A histogram of (source, point >> bits) is summed map side; the bucket in which the running sum
    passes the budget is the boundary.  Only its rows enter the next, finer histogram, until the
    boundary holds a single point.  That point joins if its overshoot is smaller than the shortfall
    without it.
    """
    state = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    state = staged(state.withColumns({
        "upto": F.lit(-1).cast("long"), "prefix": F.lit(0).cast("long"), "open": F.col("budget") > 0,
    }), "mix-state")
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        above, here = HASH_BITS - (level - 1) * LEVEL_BITS, HASH_BITS - level * LEVEL_BITS
        boundary = state.where("open").select(F.col("source").alias("_source"), "prefix", "budget")
        inside = sizes.join(
            boundary, F.col("source").eqNullSafe(F.col("_source"))
            & (F.shiftright("point", above) == F.col("prefix")),
        )
        buckets = inside.groupBy("_source", F.shiftright("point", here).alias("bucket")).agg(
            F.sum("size").alias("n"), F.min("point").alias("low"), F.max("point").alias("high"), F.first("budget").alias("budget"),
        )
        running = Window.partitionBy("_source").orderBy("bucket")
        passed = buckets.withColumn("through", F.sum("n").over(running)).groupBy("_source").agg(
            F.max(F.when(F.col("through") <= F.col("budget"), F.col("high"))).alias("full"),
            F.min(F.when(F.col("through") > F.col("budget"), F.struct("bucket", "low", "high", "through", "n"))).alias("edge"),
        )
        joined = state.join(passed, F.col("source").eqNullSafe(F.col("_source")), "left")
        left = F.col("budget") - (F.col("edge.through") - F.col("edge.n"))
        single = F.col("edge.low") == F.col("edge.high")
        state = staged(joined.select(
            "source", "source_size", "target", "whole",
            F.when(F.col("open") & single & (F.col("edge.through") - F.col("budget") < left), F.col("edge.high"))
            .otherwise(F.coalesce("full", "upto")).alias("upto"),
            F.coalesce("edge.bucket", "prefix").alias("prefix"),
            F.when(F.col("open") & F.col("edge").isNotNull(), left).otherwise(F.col("budget")).alias("budget"),
            F.coalesce(F.col("open") & ~single, F.lit(False)).alias("open"),
        ), "mix-state")
        if state.where("open").isEmpty():
            break
    return state.select("source", "source_size", "target", "whole", "upto")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``id, source, size, source_size, target, copies`` for every row.

    The size of a document is its number of words.  Targets share ``share`` times all words by
    weight, at most ``most`` times a source's words each.  A document is taken ``copies`` times:
    the whole copies that its source needs, and one more if its point lies below the threshold.
    Points depend on ids alone, so reruns agree and a larger budget only adds documents.

    Null or empty texts have size 0 and never change a sum.  Null sources form a source, the last.
    Rows with the same id stand or fall together; repeated rows count each.  Other columns are not
    carried.  An empty table gives an empty result.
    """
    sizes = staged(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        place(F.col(id_col)).alias("point"),
    ), "mix-sizes")
    found = thresholds(sizes, source_targets(sizes, weights, share, most)).withColumnRenamed("source", "_source")
    return sizes.join(found, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("whole") + (F.col("point") <= F.col("upto")).cast("long")).alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, with all their columns.

    The decision depends on (source, id) alone, so it is read from the small table of thresholds and
    texts are not shuffled by id.
    """
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    text_col = options.get("text_col", "text")
    sizes = staged(docs.select(
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), place(F.col(id_col)).alias("point"),
    ), "mix-sizes")
    targets = source_targets(sizes, options.get("weights", (5, 2, 1)), options.get("share", 1.5), options.get("most", 2))
    found = thresholds(sizes, targets).select(F.col("source").alias("_source"), F.col("whole").alias("_whole"), F.col("upto").alias("_upto"))
    # Rows travel as one struct, so that no column of theirs can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(source_col).alias("key"), place(F.col(id_col)).alias("point"))
    copies = F.col("_whole") + (F.col("point") <= F.col("_upto")).cast("long")
    taken = rows.join(found, F.col("key").eqNullSafe(F.col("_source"))).withColumn("copies", copies).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
