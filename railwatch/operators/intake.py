"""Raw JSON to normalised events: parse, validate, split, route late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.functions import instant_millis, is_scored, non_blank
from railwatch.operators.scan import SHIFTS, running
from railwatch.schemas import ARRIVAL, CORRUPT, EVENT_FIELDS, EVENT_TYPES, FINDING, JSON_PAYLOAD
from railwatch.settings import DEFAULTS, Settings

# Reasons written into the invalid and late outputs.
NO_GUARDRAIL = "Missing required field: guardrailName"
NO_CONFIDENCE = "Missing required confidence for confidence-based guardrail"
NO_TRIGGERED = "Missing required triggered field for guardrail finding"
BAD_TYPE = "Unsupported eventType: "
BAD_PAYLOAD = "Parse error: "
LATE_REASON = "Event is older than current watermark tolerance"

# Fixed value: JSON texts that are well formed but no object; they lack every field.
NO_OBJECT = r'^\s*(\[|(null|true|false|-?\d+(\.\d+)?([eE][+-]?\d+)?|"[^"\\]*")\s*$)'


def _whole(text: Column, kind: str) -> Column:
    """Number from JSON text: fractions truncate, unreadable text is 0, null stays null."""
    number = F.coalesce(
        text.try_cast(kind), text.try_cast("double").try_cast(kind), F.lit(0).cast(kind)
    )
    return F.when(text.isNotNull(), number)


def _real(text: Column) -> Column:
    lowered = F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("double"), lowered))


def _flag(text: Column) -> Column:
    # A pattern, because a failing cast costs an exception per row.
    truthy = (F.trim(text) == "true") | (text.rlike(r"^-?\d+$") & ~text.rlike(r"^-?0+$"))
    return F.when(text.isNotNull(), truthy)


def parse(raw: DataFrame) -> DataFrame:
    """One row per payload: event columns plus ``reason_code`` / ``reason`` (null when valid)."""
    payload = F.from_json(F.col("value"), JSON_PAYLOAD, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
    })
    j = lambda name: F.col(f"j.{name}")
    extra = [c for c in raw.columns if c != "value"]
    # Exploding a one-element array keeps later filters above the JSON reader; pushed below
    # it, each would read the text again for every field it looks at.
    typed = raw.select("*", F.explode(F.array(payload)).alias("j")).select(
        *extra,
        j("tenantId").alias("tenantId"),
        j("environment").alias("environment"),
        j("agentId").alias("agentId"),
        j("sessionId").alias("sessionId"),
        j("requestId").alias("requestId"),
        j("turnId").alias("turnId"),
        instant_millis(j("eventTime")).alias("eventTimeMillis"),
        j("eventType").alias("eventType"),
        j("modelName").alias("modelName"),
        j("userId").alias("userId"),
        j("channel").alias("channel"),
        F.coalesce(_whole(j("inputTokens"), "int"), F.lit(0)).alias("inputTokens"),
        F.coalesce(_whole(j("outputTokens"), "int"), F.lit(0)).alias("outputTokens"),
        j("guardrailName").alias("guardrailName"),
        j("guardrailVersion").alias("guardrailVersion"),
        j("policyVersion").alias("policyVersion"),
        _real(j("confidence")).alias("confidence"),
        _flag(j("triggered")).alias("triggered"),
        _whole(j("detectorLatencyMs"), "bigint").alias("detectorLatencyMs"),
        j("detectorStatus").alias("detectorStatus"),
        j("evidenceSnippet").alias("evidenceSnippet"),
        F.col("value").alias("rawPayload"),
        j("eventTime").alias("__time"),
        (j(CORRUPT).isNotNull() & ~F.col("value").rlike(NO_OBJECT)).alias("__broken"),
    )

    missing = lambda name: F.lit(f"{BAD_TYPE}Missing required field: {name}")
    checks: list[tuple[Column, str, Column]] = [
        (F.col("__broken"), "PARSE_ERROR", F.lit(f"{BAD_PAYLOAD}malformed JSON")),
        (F.col("eventType").isNull(), "MISSING_FIELD", missing("eventType")),
        (~F.col("eventType").isin(*EVENT_TYPES), "UNSUPPORTED_EVENT_TYPE",
         F.concat(F.lit(BAD_TYPE), F.col("eventType"))),
        (F.col("agentId").isNull(), "MISSING_FIELD", missing("agentId")),
        (F.col("sessionId").isNull(), "MISSING_FIELD", missing("sessionId")),
        (F.col("requestId").isNull(), "MISSING_FIELD", missing("requestId")),
        (F.col("__time").isNull(), "MISSING_FIELD", missing("eventTime")),
        (F.col("eventTimeMillis").isNull(), "BAD_EVENT_TIME",
         F.concat(F.lit(BAD_PAYLOAD), F.lit("unreadable eventTime "), F.col("__time"))),
        ((F.col("eventType") == FINDING) & F.col("guardrailName").isNull(),
         "MISSING_GUARDRAIL_NAME", F.lit(NO_GUARDRAIL)),
        (is_scored(F.col("guardrailName")) & F.col("confidence").isNull(),
         "MISSING_CONFIDENCE", F.lit(NO_CONFIDENCE)),
        ((F.col("eventType") == FINDING) & F.col("triggered").isNull(),
         "MISSING_TRIGGERED", F.lit(NO_TRIGGERED)),
    ]
    code, reason = F, F
    for condition, name, text in checks:
        code, reason = code.when(condition, name), reason.when(condition, text)
    return typed.select(
        *extra, *EVENT_FIELDS, code.alias("reason_code"), reason.alias("reason")
    )


def valid(parsed: DataFrame) -> DataFrame:
    """Normalised events, with the event time also as a timestamp for watermarks."""
    kept = parsed.where(F.col("reason_code").isNull()).drop("reason_code", "reason")
    return kept.withColumn("event_time", F.timestamp_millis("eventTimeMillis"))


def invalid(parsed: DataFrame) -> DataFrame:
    arrival = [c for c in ARRIVAL if c in parsed.columns]
    return parsed.where(F.col("reason_code").isNotNull()).select(
        *arrival, "reason_code", "reason", "rawPayload"
    )


def with_watermark(
    events: DataFrame, settings: Settings = DEFAULTS, shifts: Sequence[int] = SHIFTS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add ``watermark``: what was known before the row arrived, null for the first rows.

    Newest earlier event time of the same ``(source, partition)`` in arrival order, minus
    the out-of-orderness bound and one millisecond.  ``carry`` holds ``(source, partition,
    newest)`` of rows that arrived before this input, one row per partition of a source.
    """
    seen = running(
        events, "seq", {"__newest": ("max", "eventTimeMillis")},
        keys=("source", "partition"), inclusive=False, shifts=shifts,
    )
    if carry is not None:
        seen = seen.join(carry.select("source", "partition", "newest"), ["source", "partition"], "left")
        seen = seen.withColumn("__newest", F.greatest("__newest", "newest")).drop("newest")
    return seen.withColumn(
        "watermark", F.col("__newest") - F.lit(settings.out_of_orderness_ms + 1)
    ).drop("__newest")


def newest_times(events: DataFrame) -> DataFrame:
    """Newest event time per partition of a source: the carry for the next input."""
    return events.groupBy("source", "partition").agg(F.max("eventTimeMillis").alias("newest"))


def is_late(settings: Settings = DEFAULTS) -> Column:
    late = F.col("eventTimeMillis") + settings.late_tolerance_ms < F.col("watermark")
    return F.coalesce(late, F.lit(False))


def on_time(watermarked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return watermarked.where(~is_late(settings)).drop("watermark")


def late(watermarked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Late rows as ``(reason, event, currentWatermark)`` with their arrival columns."""
    event = F.struct(*EVENT_FIELDS)
    arrival = [c for c in ARRIVAL if c in watermarked.columns]
    return watermarked.where(is_late(settings)).select(
        *arrival, F.lit(LATE_REASON).alias("reason"), event.alias("event"),
        F.col("watermark").alias("currentWatermark"),
    )


def findings(events: DataFrame) -> DataFrame:
    return events.where(F.col("eventType") == FINDING)


def triggered(events: DataFrame) -> DataFrame:
    return findings(events).where(F.col("triggered"))


def evidence_bearing(events: DataFrame, guardrail: str) -> DataFrame:
    """Triggered findings of one guardrail that carry readable evidence."""
    return triggered(events).where(
        (F.col("guardrailName") == guardrail) & non_blank(F.col("evidenceSnippet"))
    )


def to_json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One ``value`` column of JSON text, nulls written out."""
    row = F.struct(*(columns or df.columns))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))
