import json
import random
from collections import Counter

import pytest

from railwatch.operators import intake
from railwatch.operators.scan import running
from railwatch.settings import Settings
from tests.rows import events, finding

REQUEST = {
    "eventType": "AGENT_REQUEST", "agentId": "a", "sessionId": "s", "requestId": "r",
    "eventTime": "2026-08-26T10:00:00.123456Z",
}
FINDING = {**REQUEST, "eventType": "GUARDRAIL_FINDING", "guardrailName": "PROMPT_INJECTION", "confidence": 0.9,
           "triggered": True}


def parse(spark, *payloads):
    texts = [p if p is None or isinstance(p, str) else json.dumps(p) for p in payloads]
    raw = spark.createDataFrame(
        [(t, "x", 0, i) for i, t in enumerate(texts)], "value string, source string, partition int, seq long"
    )
    return sorted(intake.parse(raw).collect(), key=lambda r: r.seq)


def without(payload, *names, **changes):
    return {**{k: v for k, v in payload.items() if k not in names}, **changes}


def test_valid_rows_and_defaults(spark):
    plain, full = parse(spark, REQUEST, {**FINDING, "inputTokens": 7, "evidenceSnippet": "x", "detectorLatencyMs": 12})
    assert plain.reason is None and full.reason is None
    assert plain.eventTimeMillis == 1787738400123
    assert (plain.inputTokens, plain.detectorLatencyMs, plain.triggered, plain.tenantId) == (0, None, None, None)
    assert (full.inputTokens, full.confidence, full.triggered, full.detectorLatencyMs) == (7, 0.9, True, 12)


def test_reasons_follow_the_order_of_checks(spark):
    cases = [
        (without(REQUEST, "eventType"), "MISSING_FIELD", "Unsupported eventType: Missing required field: eventType"),
        ({**without(REQUEST, "agentId"), "eventType": "X"}, "UNSUPPORTED_EVENT_TYPE", "Unsupported eventType: X"),
        (without(REQUEST, "agentId", "sessionId"), "MISSING_FIELD", "Unsupported eventType: Missing required field: agentId"),
        (without(REQUEST, "sessionId"), "MISSING_FIELD", "Unsupported eventType: Missing required field: sessionId"),
        ({**REQUEST, "requestId": None}, "MISSING_FIELD", "Unsupported eventType: Missing required field: requestId"),
        (without(REQUEST, "eventTime"), "MISSING_FIELD", "Unsupported eventType: Missing required field: eventTime"),
        ({**REQUEST, "eventTime": "2026-08-26"}, "BAD_EVENT_TIME", None),
        (without(FINDING, "guardrailName"), "MISSING_GUARDRAIL_NAME", intake.NO_GUARDRAIL),
        (without(FINDING, "confidence"), "MISSING_CONFIDENCE", intake.NO_CONFIDENCE),
        (without(FINDING, "confidence", eventType="AGENT_REQUEST"), "MISSING_CONFIDENCE", intake.NO_CONFIDENCE),
        (without(FINDING, "triggered"), "MISSING_TRIGGERED", intake.NO_TRIGGERED),
        ('{"eventType": "AGENT_REQUEST"', "PARSE_ERROR", None),
        ("", "MISSING_FIELD", None), (None, "MISSING_FIELD", None), ("[1]", "MISSING_FIELD", None),
        ("null", "MISSING_FIELD", None),
    ]
    for (payload, code, reason), row in zip(cases, parse(spark, *[c[0] for c in cases])):
        assert row.reason_code == code, payload
        if reason:
            assert row.reason == reason


def test_coercions(spark):
    rows = parse(
        spark,
        {**FINDING, "agentId": 5, "confidence": "0.5", "triggered": "true", "inputTokens": "12"},
        {**FINDING, "confidence": "high", "triggered": "yes", "inputTokens": 12.9, "outputTokens": "many"},
        {**FINDING, "triggered": 1, "unknownField": {"a": 1}},
        json.dumps(FINDING) + " trailing",
        {**FINDING, "eventTime": "2026-08-26T12:00:00+02:00"},
    )
    assert all(r.reason is None for r in rows)
    assert (rows[0].agentId, rows[0].confidence, rows[0].triggered, rows[0].inputTokens) == ("5", 0.5, True, 12)
    assert (rows[1].confidence, rows[1].triggered, rows[1].inputTokens, rows[1].outputTokens) == (0.0, False, 12, 0)
    assert rows[2].triggered is True and "unknownField" in rows[2].rawPayload
    assert rows[4].eventTimeMillis == 1787738400000


def test_split_keeps_every_row(spark):
    raw = spark.createDataFrame([(json.dumps(p), "x", 0, i) for i, p in enumerate((FINDING, {}, REQUEST))],
                                "value string, source string, partition int, seq long")
    parsed = intake.parse(raw)
    assert intake.valid(parsed).count() == 2
    assert [r.rawPayload for r in intake.invalid(parsed).collect()] == ["{}"]


def test_late_route_at_the_boundary(spark):
    # Watermark after the first row: 600000.
    first = finding(0, 600_000 + 30_001)
    rows = [first, finding(1, 300_000, confidence=0.1), finding(2, 299_999, confidence=0.1)]
    marked = intake.with_watermark(events(spark, rows))
    late = intake.late(marked).collect()
    assert [r.event.requestId for r in late] == ["req-2"]
    assert late[0].reason == intake.LATE_REASON
    assert late[0].currentWatermark - rows[0]["eventTimeMillis"] == -30_001
    assert {r.seq for r in intake.on_time(marked).collect()} == {0, 1}


def test_lateness_equals_a_plain_loop_for_any_bucket_width(spark):
    rng = random.Random(3)
    rows = [
        finding(i, rng.randrange(3_000_000), partition=int(rng.random() < 0.3), confidence=0.2) for i in range(400)
    ]
    newest, expected = {}, set()
    for r in rows:
        known = newest.get(r["partition"])
        if known is not None and r["eventTimeMillis"] + 300_000 < known - 30_001:
            expected.add(r["seq"])
        newest[r["partition"]] = max(known or 0, r["eventTimeMillis"])
    frame = events(spark, rows)
    for shifts in ((16,), (4,), (3, 2, 2)):
        marked = intake.with_watermark(frame, Settings(), shifts)
        assert {r.event.requestId for r in intake.late(marked).collect()} == {f"req-{i}" for i in expected}
    assert expected


def test_running_values(spark):
    rng = random.Random(5)
    data = [(i, rng.choice("ab"), rng.randrange(100) if rng.random() < 0.5 else None) for i in range(200)]
    frame = spark.createDataFrame(data, "i long, k string, v long")
    got = {
        r.i: (r.total, r.top, r.latest)
        for r in running(frame, "i", {"total": ("sum", "v"), "top": ("max", "v"), "latest": ("last", "v")},
                         keys=("k",), shifts=(3, 2)).collect()
    }
    for key in "ab":
        seen = []
        for i, k, v in data:
            if k == key:
                seen += [v] if v is not None else []
                assert got[i] == ((sum(seen), max(seen), seen[-1]) if seen else (None, None, None))


def test_json_rows_write_nulls(spark):
    value = intake.to_json_rows(events(spark, [finding(1, 0)]), ("requestId", "environment")).first().value
    assert json.loads(value) == {"requestId": "req-1", "environment": None}


def test_filters(spark):
    rows = [
        finding(1, 0, confidence=0.9, evidenceSnippet="  "), finding(2, 0, confidence=0.9, evidenceSnippet="do it"),
        finding(3, 0, confidence=0.9, triggered=None, evidenceSnippet="do it"),
        finding(4, 0, guardrail="TOXICITY", confidence=0.9, evidenceSnippet="do it"),
        finding(5, 0, eventType="AGENT_REQUEST", confidence=0.9, evidenceSnippet="do it"),
    ]
    frame = events(spark, rows)
    assert {r.seq for r in intake.findings(frame).collect()} == {1, 2, 3, 4}
    assert {r.seq for r in intake.triggered(frame).collect()} == {1, 2, 4}
    assert {r.seq for r in intake.evidence_bearing(frame, "PROMPT_INJECTION").collect()} == {2}


def test_only_strict_json_is_an_event(spark):
    single = json.dumps(REQUEST).replace('"', "'")
    nan = json.dumps({**FINDING, "confidence": 0.5}).replace("0.5", "NaN")
    raw = spark.createDataFrame([(single, "t", 0, 1), (nan, "t", 0, 2)], "value string, source string, partition int, seq long")
    assert [r.reason_code for r in intake.parse(raw).collect()] == ["PARSE_ERROR", "PARSE_ERROR"]


def test_events_without_evidence_are_not_dealt_to_one_task(spark):
    """Only errors have a conversation; the other rows have no key to be joined by."""
    from pyspark.sql import functions as F

    from railwatch.sources.tables import raw_events

    kind = F.element_at(F.array(*[F.lit(k) for k in ("error", "view", "click", "purchase")]), (F.col("id") % 5 + 1).cast("int"))
    events = spark.range(0, 5_000, numPartitions=8).select(
        F.col("id").alias("event_id"), F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 5 < 4, kind).alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props"))
    turns = spark.range(30).select(
        F.floor(F.col("id") / 3).alias("conv_id"), (F.col("id") % 3).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("text "), "id").alias("text"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        raw = raw_events(events, turns)
        tasks = raw.groupBy(F.spark_partition_id()).count().collect()
        texts = {r.seq: json.loads(r.value).get("evidenceSnippet") for r in raw.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(r["count"] for r in tasks) < 1_500
    assert len(texts) == 5_000
    assert all(text == (f"text {i // 128 % 10 * 3 + i % 3}" if i % 5 == 0 else None) for i, text in texts.items())


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_events_of_one_row_group_are_parsed_by_all_tasks(spark, tmp_path, threshold):
    """A task reads a whole row group; what is built from its rows must not stay there, whether conversations are broadcast or not."""
    from pyspark.sql import functions as F

    from railwatch.sources.tables import raw_events

    kind = F.element_at(F.array(*[F.lit(k) for k in ("error", "view", "click", "purchase")]), (F.col("id") % 4 + 1).cast("int"))
    spark.range(0, 20_000, numPartitions=1).select(
        F.when(F.col("id") >= 2_000, F.col("id")).alias("event_id"),
        F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), kind.alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    turns = spark.range(30).select(
        F.floor(F.col("id") / 3).alias("conv_id"), (F.col("id") % 3).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("text "), "id").alias("text"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        parsed = intake.parse(raw_events(spark.read.parquet(f"{tmp_path}/events.parquet"), turns)).select("seq", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tasks = Counter(r.task for r in parsed)
    assert len(parsed) == 20_000 and sum(r.seq is None for r in parsed) == 2_000
    assert max(tasks.values()) < 7_500
