"""Event-time window aggregates per guardrail, detector quality and emit latency.

Exact nearest-rank percentiles need all confidences of a window, and one busy agent can
own a third of them.  So no task ever holds a whole window:

1. raw findings are reduced to one row per (key, base window, confidence), map side first;
2. those rows are fanned out to the window sizes and cut into confidence slices;
3. ranks are running counts inside a slice plus the counts of the lower slices;
4. the last grouping only merges partial sums.

Raw rows are reduced and shuffled by the first step only, whatever the number of window
sizes.  Its result is read twice, so a job writes it as a table first (``Pipeline`` does).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.functions import (
    clamp_floor_zero, detector_ok, is_scored, non_blank, safe_ratio, window_name,
)
from railwatch.functions.scalars import window_start
from railwatch.operators.intake import findings
from railwatch.schemas import AGGREGATE_KEY, FINDING, LEAKAGE, LOOPING, SCORED_GUARDRAILS
from railwatch.settings import DEFAULTS, Settings

SLICES = 4096  # in each of three zones
EDGE = 1 / 64
NO_VALUE = "\u0000"  # stands for null inside the job, so that keys join with plain equality

WINDOW_KEY = (*AGGREGATE_KEY, "windowName", "windowStartMillis")

AGGREGATE_FIELDS = (
    "tenantId", *AGGREGATE_KEY, "windowName", "windowStartMillis", "windowEndMillis",
    "latestEventTimeMillis", "totalEvents", "guardrailFindingCount", "triggeredCount",
    "loopingTriggeredCount", "systemPromptLeakageTriggeredCount", "inputTokens", "outputTokens",
    "confidenceCount", "minConfidence", "avgConfidence", "maxConfidence", "p50Confidence",
    "p95Confidence", "triggeredP50Confidence", "triggeredP95Confidence", "minDetectorLatencyMs",
    "avgDetectorLatencyMs", "maxDetectorLatencyMs", "detectorErrorCount",
)
_PERCENTILES = (
    ("p50Confidence", 50, "n"), ("p95Confidence", 95, "n"),
    ("triggeredP50Confidence", 50, "n_trig"), ("triggeredP95Confidence", 95, "n_trig"),
)


def _measures() -> list[Column]:
    """Mergeable partial measures of raw findings.

    Numbers only: they fit a hash aggregation, while text or structs would make Spark sort
    the raw rows first.
    """
    fired = F.coalesce(F.col("triggered"), F.lit(False))
    name = F.col("guardrailName")
    return [
        F.count(F.lit(1)).alias("totalEvents"),
        F.count_if(F.col("eventType") == FINDING).alias("guardrailFindingCount"),
        F.count_if(fired).alias("triggeredCount"),
        F.count_if(fired & (name == LOOPING)).alias("loopingTriggeredCount"),
        F.count_if(fired & (name == LEAKAGE)).alias("systemPromptLeakageTriggeredCount"),
        F.sum(F.col("inputTokens").cast("long")).alias("inputTokens"),
        F.sum(F.col("outputTokens").cast("long")).alias("outputTokens"),
        F.max("eventTimeMillis").alias("latestEventTimeMillis"),
        F.count_if(~detector_ok(F.col("detectorStatus"))).alias("detectorErrorCount"),
        F.count("detectorLatencyMs").alias("latencyCount"),
        F.sum("detectorLatencyMs").alias("latencySum"),
        F.min("detectorLatencyMs").alias("minDetectorLatencyMs"),
        F.max("detectorLatencyMs").alias("maxDetectorLatencyMs"),
        F.count("confidence").alias("confidenceCount"),
        F.sum("confidence").alias("confidenceSum"),
        F.min("confidence").alias("minConfidence"),
        F.max("confidence").alias("maxConfidence"),
        F.count_if(fired & F.col("confidence").isNotNull()).alias("n_trig"),
    ]


_SUMMED = (
    "totalEvents", "guardrailFindingCount", "triggeredCount", "loopingTriggeredCount",
    "systemPromptLeakageTriggeredCount", "inputTokens", "outputTokens", "detectorErrorCount",
    "latencyCount", "latencySum", "confidenceCount", "confidenceSum",
)
_LEAST = ("minDetectorLatencyMs", "minConfidence")
_GREATEST = ("latestEventTimeMillis", "maxDetectorLatencyMs", "maxConfidence")


def _merged() -> list[Column]:
    # The tenant of a window is the first that arrived.
    first = F.min(F.when(F.col("tenant") != NO_VALUE, F.struct("firstSeq", "tenant")))["tenant"]
    return (
        [first.alias("tenantId")] + [F.sum(c).alias(c) for c in _SUMMED]
        + [F.min(c).alias(c) for c in _LEAST]
        + [F.max(c).alias(c) for c in _GREATEST]
    )


def _finish(merged: DataFrame) -> DataFrame:
    size = F.col("windowSizeMillis")
    return merged.select(
        "tenantId",
        *[F.when(F.col(c) != NO_VALUE, F.col(c)).alias(c) for c in AGGREGATE_KEY],
        window_name(size).alias("windowName"),
        "windowStartMillis",
        (F.col("windowStartMillis") + size).alias("windowEndMillis"),
        clamp_floor_zero(F.col("latestEventTimeMillis")).alias("latestEventTimeMillis"),
        "totalEvents", "guardrailFindingCount", "triggeredCount", "loopingTriggeredCount",
        "systemPromptLeakageTriggeredCount", "inputTokens", "outputTokens", "confidenceCount",
        "minConfidence",
        F.when(F.col("confidenceCount") > 0, F.col("confidenceSum") / F.col("confidenceCount"))
        .alias("avgConfidence"),
        "maxConfidence", *[name for name, _, _ in _PERCENTILES], "minDetectorLatencyMs",
        F.when(F.col("latencyCount") > 0, F.col("latencySum") / F.col("latencyCount"))
        .alias("avgDetectorLatencyMs"),
        "maxDetectorLatencyMs", "detectorErrorCount",
    )


def _keyed(events: DataFrame) -> DataFrame:
    """Findings with a key that has no nulls, and the tenant where one is named."""
    keyed = findings(events).withColumns(
        {c: F.coalesce(F.col(c), F.lit(NO_VALUE)) for c in AGGREGATE_KEY}
    )
    named = F.when(non_blank(F.col("tenantId")), F.col("tenantId")).otherwise(F.lit(NO_VALUE))
    return keyed.withColumn("tenant", named)


def value_counts(events: DataFrame, base_ms: int) -> DataFrame:
    """Partial measures per (key, base window, confidence, tenant); mergeable across inputs."""
    score = F.when(is_scored(F.col("guardrailName")), F.col("confidence"))
    return _keyed(events).groupBy(
        *AGGREGATE_KEY, window_start(F.col("eventTimeMillis"), base_ms).alias("baseStart"), score.alias("score"), "tenant",
    ).agg(F.min("seq").alias("firstSeq"), *_measures())


def merged_value_counts(parts: DataFrame) -> DataFrame:
    """One row per key of :func:`value_counts` from the rows of several inputs."""
    return parts.groupBy(*AGGREGATE_KEY, "baseStart", "score", "tenant").agg(
        *[F.sum(c).alias(c) for c in (*_SUMMED, "n_trig")], *[F.min(c).alias(c) for c in ("firstSeq", *_LEAST)],
        *[F.max(c).alias(c) for c in _GREATEST],
    )


def score_slice(score: Column, slices: int = SLICES) -> Column:
    """The slice of a score: numbers that never fall as scores rise.

    Detectors are sure of most of what they see, so the outer 64ths of [0, 1] are cut as finely as all
    between them.  Values outside [0, 1] fall into the two outer slices; NaN sorts last.
    """
    within = lambda low, width: F.floor((score - low) / width * slices)
    inner = F.least(within(EDGE, 1 - 2 * EDGE), F.lit(slices - 1))
    top = F.when(F.isnan(score), slices).otherwise(F.least(within(1 - EDGE, EDGE), F.lit(slices)))
    return F.when(score < EDGE, F.greatest(within(0.0, EDGE), F.lit(-1))).when(
        score < 1 - EDGE, inner + slices).otherwise(top + 2 * slices).cast("int")


def aggregate_value_counts(
    counts: DataFrame, sizes_ms: Sequence[int], slices: int = SLICES
) -> DataFrame:
    """Window aggregates from :func:`value_counts` rows at a divisor of every size."""
    sizes = F.explode(F.array(*[F.lit(int(s)).cast("long") for s in sizes_ms]))
    scored = F.col("score").isNotNull()
    cut = F.when(scored, score_slice(F.col("score"), slices)).otherwise(F.lit(-2))
    sized = (
        counts.select("*", sizes.alias("windowSizeMillis"))
        .withColumn("windowStartMillis", window_start(F.col("baseStart"), F.col("windowSizeMillis")))
        .withColumn("slice", cut)
        .withColumn("n", F.when(scored, F.col("totalEvents")).otherwise(F.lit(0)))
        .withColumn("n_trig", F.when(scored, F.col("n_trig")).otherwise(F.lit(0)))
    )
    key = [*AGGREGATE_KEY, "windowSizeMillis", "windowStartMillis"]

    inside = (
        Window.partitionBy(*key, "slice").orderBy("score")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = sized.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in ("n", "n_trig")})

    # At most 3 * slices + 3 rows per window from here on.
    per_slice = sized.groupBy(*key, "slice").agg(F.sum("n").alias("n"), F.sum("n_trig").alias("n_trig"))
    lower = (
        Window.partitionBy(*key).orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*key)
    offsets = per_slice.select(
        *key, "slice",
        *[(F.sum(c).over(lower) - F.col(c)).alias(f"low_{c}") for c in ("n", "n_trig")],
        *[F.sum(c).over(whole).alias(f"all_{c}") for c in ("n", "n_trig")],
    )

    picks = []
    for name, percent, c in _PERCENTILES:
        rank = F.floor((F.col(f"all_{c}") * percent + 99) / 100)
        upto = F.col(f"low_{c}") + F.col(f"cum_{c}")
        hit = (upto >= rank) & (upto - F.col(c) < rank)
        picks.append(F.max(F.when(hit, F.col("score"))).alias(name))
    merged = ranked.join(offsets, [*key, "slice"]).groupBy(*key).agg(*_merged(), *picks)
    return _finish(merged)


def window_aggregates(
    events: DataFrame, sizes_ms: Sequence[int] | None = None, settings: Settings = DEFAULTS,
    slices: int = SLICES,
) -> DataFrame:
    """Aggregates of every configured tumbling window size, in one pass over the findings."""
    sizes = tuple(sizes_ms or settings.window_sizes_ms)
    return aggregate_value_counts(value_counts(events, reduce(gcd, sizes)), sizes, slices)


def compact_aggregates(events: DataFrame, sizes_ms: Sequence[int]) -> DataFrame:
    """The same aggregates in one shuffle: exact percentiles from a value map per window.

    For windows of a bounded number of distinct confidences, and for streams.
    """
    sizes = F.explode(F.array(*[F.lit(int(s)).cast("long") for s in sizes_ms]))
    keyed = _keyed(events).select("*", sizes.alias("windowSizeMillis"))
    start = window_start(F.col("eventTimeMillis"), F.col("windowSizeMillis"))
    first = F.min(F.when(F.col("tenant") != NO_VALUE, F.struct("seq", "tenant")))["tenant"]
    return _finish(
        keyed.groupBy(*AGGREGATE_KEY, "windowSizeMillis", start.alias("windowStartMillis"))
        .agg(first.alias("tenantId"), *_measures(), *value_map_percentiles())
    )


def value_map_percentiles() -> list[Column]:
    score = f"CASE WHEN guardrailName IN ({', '.join(repr(g) for g in SCORED_GUARDRAILS)}) {{}} THEN confidence END"
    return [
        F.expr(
            f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY "
            f"{score.format('AND triggered' if c == 'n_trig' else '')})"
        ).alias(name)
        for name, percent, c in _PERCENTILES
    ]


def with_emit_latency(aggregates: DataFrame, emitted_at_ms: Column | int) -> DataFrame:
    """Latest-event-to-emit and window-end-to-emit, never negative."""
    at = emitted_at_ms if isinstance(emitted_at_ms, Column) else F.lit(emitted_at_ms).cast("long")
    return aggregates.withColumns({
        "e2eLatestEventToEmitMs": clamp_floor_zero(at - F.col("latestEventTimeMillis")),
        "e2eWindowEndToEmitMs": clamp_floor_zero(at - F.col("windowEndMillis")),
    })


def quality_metrics(aggregates: DataFrame) -> DataFrame:
    """Detector-quality row of each aggregate; confidence columns only where scored."""
    found, scored = F.col("guardrailFindingCount"), is_scored(F.col("guardrailName"))
    missing = F.greatest(F.lit(0).cast("long"), found - F.col("confidenceCount"))
    latency = [c for c in ("e2eLatestEventToEmitMs", "e2eWindowEndToEmitMs") if c in aggregates.columns]
    return aggregates.select(
        "tenantId", *AGGREGATE_KEY, "windowName", "windowStartMillis", "windowEndMillis",
        "latestEventTimeMillis", "guardrailFindingCount", "triggeredCount",
        safe_ratio(F.col("triggeredCount"), found).alias("triggerRate"),
        "detectorErrorCount",
        safe_ratio(F.col("detectorErrorCount"), found).alias("detectorErrorRate"),
        F.when(scored, missing).alias("missingConfidenceCount"),
        F.when(scored, safe_ratio(missing, found)).alias("missingConfidenceRate"),
        F.when(scored, safe_ratio(F.col("confidenceCount"), found)).alias("confidenceCoverageRate"),
        "confidenceCount", "minDetectorLatencyMs", "avgDetectorLatencyMs", "maxDetectorLatencyMs",
        *latency,
    )


def latest_aggregates(emissions: DataFrame) -> DataFrame:
    """Final revision of every window: of all emissions, the one that saw most events."""
    return latest_rows(emissions, "totalEvents", "latestEventTimeMillis")


def latest_rows(emissions: DataFrame, *order: str) -> DataFrame:
    """Of all emissions of a window the row that is greatest in ``order``."""
    keyed = emissions.withColumns(
        {f"__k_{c}": F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in WINDOW_KEY}
    )
    best = keyed.groupBy(*[f"__k_{c}" for c in WINDOW_KEY]).agg(F.max_by(F.struct(*emissions.columns), F.struct(*order)).alias("row"))
    return best.select("row.*")
