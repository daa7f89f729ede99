"""Review of results: severity bands, slices, suppression, audit samples, label checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.functions import safe_ratio
from railwatch.functions.scalars import window_start
from railwatch.operators.intake import findings
from railwatch.operators.scan import running
from railwatch.schemas import LEAKAGE, LOOPING, PROMPT_INJECTION, TOXICITY

# First severity bands of single findings, strongest first.
BANDS = {
    PROMPT_INJECTION: ((0.90, "CRITICAL"), (0.75, "HIGH"), (0.55, "MEDIUM")),
    TOXICITY: ((0.90, "HIGH"), (0.70, "MEDIUM")),
}
BOOLEAN_BANDS = {LOOPING: "MEDIUM", LEAKAGE: "CRITICAL"}
_SHIFTS = (18,)


def severity_band(name: Column, confidence: Column, fired: Column) -> Column:
    band = F
    for guardrail, steps in BANDS.items():
        for least, severity in steps:
            band = band.when((name == guardrail) & (confidence >= least), severity)
    for guardrail, severity in BOOLEAN_BANDS.items():
        band = band.when((name == guardrail) & fired, severity)
    return band.otherwise("LOW")


def with_severity(events: DataFrame) -> DataFrame:
    band = severity_band(F.col("guardrailName"), F.col("confidence"), F.col("triggered"))
    return findings(events).withColumn("severity", band)


def affected_sessions(events: DataFrame, size_ms: int) -> DataFrame:
    """Per agent and window, distinct sessions with a triggered finding."""
    start = window_start(F.col("eventTimeMillis"), size_ms)
    return findings(events).groupBy("agentId", start.alias("windowStartMillis")).agg(
        F.count_distinct(F.when(F.col("triggered"), F.col("sessionId"))).alias("affectedSessions")
    )


def slices(events: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Finding counts rolled up over ``dimensions``; a null dimension is a subtotal."""
    return findings(events).rollup(*dimensions).agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(F.col("triggered")).alias("triggered"),
        F.sum(F.col("outputTokens").cast("long")).alias("outputTokens"),
    )


def window_slices(events: DataFrame, dimensions: Sequence[str], size_ms: int) -> DataFrame:
    """Finding counts per window and value of each dimension, one row per (dimension, value)."""
    slices_of = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions
    ]))
    start = window_start(F.col("eventTimeMillis"), size_ms).alias("windowStartMillis")
    return findings(events).select("triggered", "outputTokens", start, slices_of.alias("s")).groupBy(
        "windowStartMillis", "s.dimension", "s.value"
    ).agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(F.col("triggered")).alias("triggered"),
        F.sum(F.col("outputTokens").cast("long")).alias("outputTokens"),
    )


def latency_by_version(events: DataFrame, percent: int = 95) -> DataFrame:
    """Nearest-rank detector latency per guardrail version.

    Latencies are whole milliseconds, so the value map per group is small.
    """
    rank = F.expr(f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY detectorLatencyMs)")
    return findings(events).groupBy("guardrailName", "guardrailVersion").agg(
        F.count(F.lit(1)).alias("findings"), rank.cast("long").alias("latencyMs"), F.max("detectorLatencyMs").alias("maxLatencyMs"),
    )


def version_drift(events: DataFrame) -> DataFrame:
    """Change of mean confidence and trigger rate from one guardrail version to the next."""
    rates = findings(events).groupBy("guardrailName", "guardrailVersion").agg(
        F.count(F.lit(1)).alias("findings"), F.avg("confidence").alias("avgConfidence"),
        F.avg(F.when(F.col("triggered"), 1.0).otherwise(0.0)).alias("triggerRate"),
    )
    # One row per version from here on.
    order = Window.partitionBy("guardrailName").orderBy("guardrailVersion")
    return rates.withColumns({
        f"{c}Drift": F.col(c) - F.lag(c).over(order) for c in ("avgConfidence", "triggerRate")
    })


def incidents_by_version(incidents: DataFrame, scope: Sequence[str] = ("agentId",)) -> DataFrame:
    """Incidents per guardrail version inside ``scope``, e.g. an agent or ``("agentId", "sessionId")``."""
    return incidents.select(*scope, "ruleName", F.explode("guardrailVersions").alias("guardrailVersion")).groupBy(
        *scope, "ruleName", "guardrailVersion"
    ).agg(F.count(F.lit(1)).alias("incidents"))


def incidents_per_session(incidents: DataFrame) -> DataFrame:
    """Incidents of every session: how many, under how many rules, of which severities, first and last."""
    severe = lambda name: F.count_if(F.col("severity") == name)
    return incidents.groupBy("agentId", "sessionId").agg(
        F.count(F.lit(1)).alias("incidents"), F.count_distinct("ruleName").alias("rules"),
        severe("CRITICAL").alias("critical"), severe("HIGH").alias("high"), severe("MEDIUM").alias("medium"),
        F.min("emittedAtEventTimeMillis").alias("firstIncidentMillis"), F.max("emittedAtEventTimeMillis").alias("lastIncidentMillis"),
    )


def affected_sketches(events: DataFrame, size_ms: int) -> DataFrame:
    """As :func:`affected_sessions`, the distinct sessions as a sketch that merges with others of the window.

    The sketch holds some hundred sessions exactly; beyond that its relative standard error is 1.6 %, in four kilobytes.
    """
    start = window_start(F.col("eventTimeMillis"), size_ms)
    return findings(events).groupBy("agentId", start.alias("windowStartMillis")).agg(
        F.hll_sketch_agg(F.when(F.col("triggered"), F.col("sessionId")), 12).alias("sketch")
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    merged = sketches.groupBy("agentId", "windowStartMillis").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("agentId", "windowStartMillis", F.hll_sketch_estimate("sketch").alias("affectedSessions"))


def suppressed(incidents: DataFrame, within_ms: int = 180_000, limit: int = 3) -> DataFrame:
    """Mark repeats: the same rule of a session within ``within_ms`` of its predecessor, and
    everything beyond ``limit`` kept incidents of one session lifetime."""
    rule = ("agentId", "sessionId", "ruleName")
    # Emissions of one event are placed by rule name.
    marked = running(
        incidents, "emittedAtEventTimeMillis", {"__previous": ("last", "emittedAtEventTimeMillis")}, rule,
        inclusive=False, shifts=_SHIFTS, ties=("emissionRevision",),
    )
    repeat = F.coalesce(F.col("emittedAtEventTimeMillis") - F.col("__previous") <= within_ms, F.lit(False))
    counted = running(
        marked.withColumns({"duplicate": repeat, "__one": F.when(~repeat, 1).otherwise(0)}), "emittedAtEventTimeMillis",
        {"__kept": ("sum", "__one")}, ("agentId", "sessionId", "firstEventTimeMillis"), shifts=_SHIFTS,
        ties=("ruleName", "emissionRevision"),
    )
    return counted.withColumn("overLimit", ~F.col("duplicate") & (F.col("__kept") > limit)).drop(
        "__previous", "__one", "__kept"
    )


def audit_sample(events: DataFrame, per_mille: int = 100) -> DataFrame:
    """Reproducible sample of requests; the inclusion probability is recorded on each row."""
    bucket = F.conv(F.substring(F.md5("requestId"), 1, 8), 16, 10).cast("long") % 1000
    return events.where(bucket < per_mille).withColumn("inclusionProbability", F.lit(per_mille / 1000))


def detector_quality(judged: DataFrame) -> DataFrame:
    """Precision, recall and false-positive rate of ``detected`` against ``label``.

    ``probability`` is the chance that a row came into review; rows weigh its inverse.
    """
    weight = 1 / F.col("probability")
    cell = lambda d, l: F.sum(
        F.when((F.col("detected") == d) & (F.col("label") == l), weight).otherwise(0.0)
    )
    table = judged.groupBy("guardrailName").agg(
        F.count(F.lit(1)).alias("judged"), cell(True, True).alias("tp"), cell(True, False).alias("fp"),
        cell(False, True).alias("fn"), cell(False, False).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return table.withColumns({
        "precision": safe_ratio(tp, tp + fp), "recall": safe_ratio(tp, tp + fn),
        "falsePositiveRate": safe_ratio(fp, fp + tn), "disagreementRate": safe_ratio(fp + fn, tp + fp + fn + tn),
    })
