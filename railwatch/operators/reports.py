"""Report queries over the output tables: final aggregates, quality rows, incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.functions import (
    clamp_floor_zero, instant_millis, is_scored, non_blank, window_name,
)
from railwatch.functions.scalars import window_start
from railwatch.operators.intake import is_late
from railwatch.schemas import FINDING, PROMPT_INJECTION, REQUEST, RESPONSE
from railwatch.settings import DEFAULTS, MINUTE_MS, Settings


def _guardrail() -> Column:
    return F.coalesce(F.col("guardrailName"), F.lit("UNKNOWN")).alias("guardrail")


def _of_window(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(F.col("windowName") == name)


def _one_row(*singles: DataFrame) -> DataFrame:
    """Single rows with different columns put side by side, without a join."""
    stacked = singles[0]
    for single in singles[1:]:
        stacked = stacked.unionByName(single, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def totals(aggregates: DataFrame, window: str = "1m") -> DataFrame:
    """Aggregates, triggered findings, detector errors and events per window."""
    return _of_window(aggregates, window).groupBy("windowStartMillis").agg(
        F.count(F.lit(1)).alias("aggregates"), F.sum("triggeredCount").alias("triggered"),
        F.sum("detectorErrorCount").alias("detectorErrors"), F.sum("totalEvents").alias("events"),
    )


def by_guardrail(aggregates: DataFrame, window: str = "1m") -> DataFrame:
    return _of_window(aggregates, window).groupBy("windowStartMillis", _guardrail()).agg(
        F.sum("triggeredCount").alias("triggered"), F.sum("totalEvents").alias("events"),
        F.sum("detectorErrorCount").alias("detectorErrors"),
    )


def triggered_share(aggregates: DataFrame, window: str = "1m") -> DataFrame:
    share = F.sum("triggeredCount") / F.greatest(F.sum("totalEvents"), F.lit(1))
    return _of_window(aggregates, window).groupBy("windowStartMillis", _guardrail()).agg(
        share.alias("triggeredShare")
    )


def tokens(aggregates: DataFrame, window: str = "1m") -> DataFrame:
    return _of_window(aggregates, window).groupBy("windowStartMillis", _guardrail()).agg(
        F.sum("inputTokens").alias("inputTokens"), F.sum("outputTokens").alias("outputTokens")
    )


def last_values(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Per guardrail and window name, the maximum over agents in the newest window.

    Maxima are taken per window first, so the step that looks for the newest one sees a row
    per window instead of a row per agent.
    """
    per_window = rows.groupBy(_guardrail(), "windowName", "windowStartMillis").agg(
        *[F.max(source).alias(out) for out, source in columns.items()]
    )
    newest = F.max_by(F.struct("windowStartMillis", *columns), "windowStartMillis")
    return per_window.groupBy("guardrail", "windowName").agg(newest.alias("v")).select(
        "guardrail", "windowName", "v.*"
    )


def last_percentiles(aggregates: DataFrame) -> DataFrame:
    return last_values(aggregates.where(is_scored(F.col("guardrailName"))), {
        "p50": "p50Confidence", "p95": "p95Confidence",
        "triggeredP50": "triggeredP50Confidence", "triggeredP95": "triggeredP95Confidence",
    })


def quality_totals(quality: DataFrame, window: str = "1m") -> DataFrame:
    return _of_window(quality, window).groupBy("windowStartMillis").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("detectorErrorRate").alias("maxDetectorErrorRate"),
        F.max("missingConfidenceRate").alias("maxMissingConfidenceRate"),
        F.max("maxDetectorLatencyMs").alias("maxDetectorLatencyMs"),
    )


def quality_by_guardrail(quality: DataFrame) -> DataFrame:
    return last_values(quality, {
        "detectorErrorRate": "detectorErrorRate", "triggerRate": "triggerRate",
        "confidenceCoverageRate": "confidenceCoverageRate",
        "avgDetectorLatencyMs": "avgDetectorLatencyMs", "maxDetectorLatencyMs": "maxDetectorLatencyMs",
    })


def emit_latency(aggregates: DataFrame) -> DataFrame:
    return last_values(aggregates, {
        "latestEventToEmitMs": "e2eLatestEventToEmitMs", "windowEndToEmitMs": "e2eWindowEndToEmitMs",
    })


def incident_latency(incidents: DataFrame, emitted_at_ms: int) -> DataFrame:
    delay = clamp_floor_zero(F.lit(emitted_at_ms).cast("long") - F.col("lastEventTimeMillis"))
    return incidents.groupBy("ruleName").agg(
        F.max_by(delay, F.struct("emittedAtEventTimeMillis", "incidentId")).alias("lastEventToEmitMs")
    )


def emissions_by_window(aggregates: DataFrame) -> DataFrame:
    return aggregates.groupBy("windowName").agg(F.count(F.lit(1)).alias("emitted"))


def intake(parsed: DataFrame, watermarked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: valid, invalid, late and on-time events."""
    checks = parsed.agg(
        F.count_if(F.col("reason_code").isNull()).alias("validEvents"),
        F.count_if(F.col("reason_code").isNotNull()).alias("invalidEvents"),
    )
    routes = watermarked.agg(
        F.count_if(is_late(settings)).alias("lateEvents"),
        F.count_if(~is_late(settings)).alias("onTimeEvents"),
    )
    return _one_row(checks, routes)


def incidents_by_rule(incidents: DataFrame, window_ms: int = 5 * MINUTE_MS) -> DataFrame:
    start = window_start(F.col("emittedAtEventTimeMillis"), window_ms)
    return incidents.groupBy(start.alias("windowStartMillis"), "ruleName").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.count_if(F.col("emissionRevision") > 1).alias("updates"),
    )


def incidents_by_severity(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("ruleName", "severity").agg(F.count(F.lit(1)).alias("incidents"))


def policy_updates(parsed: DataFrame, decided: DataFrame) -> DataFrame:
    """One row: accepted, rejected and invalid updates, time of the last accepted one.

    ``decided`` starts with the bootstrap policy, which is not an update.
    """
    invalid = parsed.agg(F.count_if(F.col("policy").isNull()).alias("invalidUpdates"))
    update = F.col("seq") >= 0
    decisions = decided.agg(
        F.count_if(update & F.col("accepted")).alias("acceptedUpdates"),
        F.count_if(update & ~F.col("accepted")).alias("rejectedUpdates"),
        F.max_by(
            F.coalesce(instant_millis(F.col("policy.updatedAt")), F.lit(0).cast("long")),
            F.when(F.col("accepted"), F.col("seq")),
        ).alias("lastUpdateEpochMs"),
    )
    return _one_row(decisions, invalid)


def replay_summary(parsed: DataFrame, watermarked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row about a replayed batch: rows by type, faults, triggers, evidence."""
    kind = F.col("eventType")
    finding = kind == FINDING
    rows = parsed.agg(
        F.count_if(kind == REQUEST).alias("requests"),
        F.count_if(kind == RESPONSE).alias("responses"),
        F.count_if(finding).alias("findings"),
        F.count_if(finding & F.col("triggered")).alias("triggeredFindings"),
        F.count_if(F.col("reason_code").isNotNull()).alias("invalid"),
        F.count_if(finding & (F.upper("detectorStatus") == "ERROR")).alias("detectorErrors"),
        F.count_if(
            finding & (F.col("guardrailName") == PROMPT_INJECTION) & non_blank(F.col("evidenceSnippet"))
        ).alias("evidenceBearingInjections"),
    )
    late = watermarked.agg(F.count_if(is_late(settings)).alias("late"))
    return _one_row(rows, late)


def run_verdict(snapshots: DataFrame) -> DataFrame:
    """Verdict on each load run from its exit code, checkpoints, backpressure and lag."""
    end, settled, recovered = F.col("lag_at_end"), F.col("lag_after_settle"), F.col("lag_after_recovery")
    pressed = (F.coalesce("failed_checkpoints", F.lit(0)) > 0) | (
        F.coalesce("backpressure_ms_per_second", F.lit(0)) >= 100
    )
    verdict = (
        F.when(F.col("generator_exit_code") != 0, "failed")
        .when(pressed, "degraded")
        .when((recovered == 0) & ((end > 0) | (settled > 0)), "recovered")
        .when((recovered > 0) & (recovered < settled), "still-draining")
        .when(recovered > 0, "not-recovering")
        .otherwise("stable")
    )
    return snapshots.withColumn("verdict", verdict)


def runtime_contract(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The configured contract next to what passed through it: one row per event type."""
    names = F.array_join(
        F.array(*[window_name(F.lit(s).cast("long")) for s in settings.window_sizes_ms]), ","
    )
    return events.groupBy("eventType").agg(
        F.count(F.lit(1)).alias("passedEvents"), F.max("eventTimeMillis").alias("latestEventTimeMillis")
    ).select(
        "eventType", "passedEvents", "latestEventTimeMillis",
        F.lit(settings.window_type).alias("windowType"),
        names.alias("aggregateWindows"),
        F.lit(settings.delivery_guarantee).alias("deliveryGuarantee"),
        *[
            F.lit(ms // 1000).cast("long").alias(name) for name, ms in (
                ("outOfOrdernessSeconds", settings.out_of_orderness_ms),
                ("lateToleranceSeconds", settings.late_tolerance_ms),
                ("idleTimeoutSeconds", settings.idle_timeout_ms),
                ("checkpointIntervalSeconds", settings.checkpoint_interval_ms),
                ("watermarkIntervalSeconds", settings.watermark_interval_ms),
            )
        ],
    )
