import math
import random

import pytest
from pyspark.sql import functions as F

from railwatch.functions import window_name
from railwatch.operators import aggregates as A
from tests.rows import BASE, events, finding


def one(spark, rows, sizes=(60_000,), **options):
    return sorted(
        A.window_aggregates(events(spark, rows), sizes, **options).collect(), key=lambda r: (r.windowName, r.windowStartMillis)
    )


WINDOWS = [
    finding(1, 5_000, confidence=0.91, detectorLatencyMs=10), finding(2, 25_000, confidence=0.82, detectorLatencyMs=12),
    finding(3, 65_000, confidence=0.74, triggered=False, detectorLatencyMs=14),
    finding(4, 80_000, confidence=0.66, triggered=False, detectorLatencyMs=16),
]


def test_two_one_minute_windows(spark):
    first, second = one(spark, WINDOWS)
    assert (first.totalEvents, first.triggeredCount, first.windowStartMillis) == (2, 2, BASE)
    assert (first.p50Confidence, first.p95Confidence) == (0.82, 0.91)
    assert (first.triggeredP50Confidence, first.triggeredP95Confidence) == (0.82, 0.91)
    assert (first.inputTokens, first.outputTokens, first.latestEventTimeMillis) == (200, 100, BASE + 25_000)
    assert (second.totalEvents, second.triggeredCount) == (2, 0)
    assert (second.p50Confidence, second.p95Confidence) == (0.66, 0.74)
    assert second.triggeredP50Confidence is None and second.triggeredP95Confidence is None


def test_sizes_share_one_pass(spark):
    rows = one(spark, WINDOWS, (60_000, 300_000))
    assert [r.windowName for r in rows] == ["1m", "1m", "5m"]
    assert (rows[2].totalEvents, rows[2].p50Confidence, rows[2].triggeredP50Confidence) == (4, 0.74, 0.82)


def test_boolean_guardrail_has_no_percentiles(spark):
    row, = one(spark, [finding(1, 0, "LOOPING"), finding(2, 1, "LOOPING", confidence=0.4)])
    assert (row.p50Confidence, row.p95Confidence, row.triggeredP50Confidence) == (None, None, None)
    assert (row.loopingTriggeredCount, row.confidenceCount, row.maxConfidence) == (2, 1, 0.4)


def test_measures(spark):
    row, = one(spark, [
        finding(1, 0, confidence=0.91, detectorLatencyMs=15),
        finding(2, 1, confidence=0.73, detectorLatencyMs=25, detectorStatus="ERROR", triggered=False),
    ])
    assert (row.totalEvents, row.triggeredCount, row.detectorErrorCount) == (2, 1, 1)
    assert (row.minConfidence, row.maxConfidence) == (0.73, 0.91)
    assert row.avgConfidence == pytest.approx(0.82)
    assert (row.minDetectorLatencyMs, row.avgDetectorLatencyMs, row.maxDetectorLatencyMs) == (15, 20.0, 25)


def test_status_and_tenant(spark):
    row, = one(spark, [
        finding(3, 9, "LOOPING", detectorStatus="ok", tenantId="late"),
        finding(1, 0, "LOOPING", detectorStatus=None, tenantId="  "),
        finding(2, 1, "LOOPING", detectorStatus="TIMEOUT", tenantId="first", detectorLatencyMs=None),
    ])
    assert (row.detectorErrorCount, row.tenantId, row.minDetectorLatencyMs) == (1, "first", 10)


def test_null_keys_form_a_group(spark):
    rows = one(spark, [finding(i, i, "LOOPING", guardrailVersion=None, modelName=None) for i in range(3)])
    assert [(r.totalEvents, r.guardrailVersion, r.modelName) for r in rows] == [(3, None, None)]


def nearest_rank(values, percent):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(percent / 100 * len(ordered))) - 1] if ordered else None


@pytest.mark.parametrize("slices", [1, 7, 256])
def test_percentiles_of_a_busy_window(spark, slices):
    rng = random.Random(slices)
    values = [rng.choice([rng.random(), 0.5, -0.3, 1.7]) for _ in range(997)]
    rows = [finding(i, i, confidence=v, triggered=v > 0.4) for i, v in enumerate(values)]
    row, = one(spark, rows, slices=slices)
    fired = [v for v in values if v > 0.4]
    assert row.p50Confidence == nearest_rank(values, 50) and row.p95Confidence == nearest_rank(values, 95)
    assert row.triggeredP50Confidence == nearest_rank(fired, 50)
    assert row.triggeredP95Confidence == nearest_rank(fired, 95)


def test_nearest_rank_for_every_small_count(spark):
    rows = [
        finding(n * 1000 + i, i, confidence=(i * 43 % n) / n, agentId=f"agent-{n}") for n in range(1, 41) for i in range(n)
    ]
    for row in one(spark, rows):
        n = int(row.agentId.split("-")[1])
        assert row.p50Confidence == nearest_rank([i / n for i in range(n)], 50)
        assert row.p95Confidence == nearest_rank([i / n for i in range(n)], 95)


def test_compact_form_agrees(spark):
    rng = random.Random(1)
    rows = [
        finding(i, rng.randrange(600_000), rng.choice(["PROMPT_INJECTION", "TOXICITY", "LOOPING"]),
                round(rng.random(), 2), rng.random() < 0.5, agentId=rng.choice(["a", "b"]))
        for i in range(300)
    ]
    frame = events(spark, rows)
    rounded = lambda df: df.withColumn("avgConfidence", F.round("avgConfidence", 9))
    a = rounded(A.window_aggregates(frame, (60_000, 300_000)))
    b = rounded(A.compact_aggregates(frame, (60_000, 300_000)))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_latency_is_never_negative(spark):
    frame = A.window_aggregates(events(spark, WINDOWS), (60_000,))
    for row in A.with_emit_latency(frame, BASE + 70_000).collect():
        assert row.e2eLatestEventToEmitMs == max(0, BASE + 70_000 - row.latestEventTimeMillis)
        assert row.e2eWindowEndToEmitMs == max(0, BASE + 70_000 - row.windowEndMillis)


def test_quality(spark):
    rows = [
        finding(1, 0, confidence=0.9), finding(2, 1, confidence=None, triggered=False, detectorStatus="ERROR"),
        finding(3, 2, "LOOPING"),
    ]
    quality = {r.guardrailName: r for r in A.quality_metrics(A.window_aggregates(events(spark, rows), (60_000,))).collect()}
    scored, plain = quality["PROMPT_INJECTION"], quality["LOOPING"]
    assert (scored.triggerRate, scored.detectorErrorRate) == (0.5, 0.5)
    assert (scored.missingConfidenceCount, scored.missingConfidenceRate, scored.confidenceCoverageRate) == (1, 0.5, 0.5)
    assert plain.triggerRate == 1.0
    assert (plain.missingConfidenceCount, plain.missingConfidenceRate, plain.confidenceCoverageRate) == (None,) * 3


def test_last_revision_wins(spark):
    early = A.window_aggregates(events(spark, WINDOWS[:1]), (60_000,))
    final = A.window_aggregates(events(spark, WINDOWS), (60_000,))
    rows = A.latest_aggregates(early.unionByName(final)).collect()
    assert sorted(r.totalEvents for r in rows) == [2, 2]


def test_window_names(spark):
    sizes = {60_000: "1m", 300_000: "5m", 7_200_000: "120m", 90_000: "90s", 15_000: "15s"}
    frame = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", window_name(F.col("s")).alias("n"))
    assert {r.s: r.n for r in frame.collect()} == sizes


def test_sure_scores_spread_over_many_slices(spark):
    """Scores of .99x, as sure detectors give: no slice holds over a 64th of them."""
    from railwatch.operators.aggregates import score_slice

    for low, high in ((0.99, 0.999), (0.0, 1.0), (0.001, 0.01), (0.4, 0.6)):
        scores = spark.range(20_000).selectExpr(f"{low} + ({high} - {low}) * id / 20000 AS score")
        placed = scores.select("score", score_slice(F.col("score")).alias("slice"))
        assert placed.groupBy("slice").count().agg(F.max("count")).first()[0] <= 20_000 / 64
        rows = [r.slice for r in placed.orderBy("score").collect()]
        assert rows == sorted(rows)
    edge = spark.sql("SELECT explode(array(double('-infinity'), -1d, 0d, 0.015625d, 0.5d, 0.984375d, 1d, 2d, double('infinity'), double('nan'))) AS score")
    found = [r.slice for r in edge.select("score", score_slice(F.col("score")).alias("slice")).collect()]
    assert found == sorted(found) and found[0] == -1
