"""Correlations inside a session and a request, and enrichment with reference tables.

Everything that looks backwards in a session uses the bucketed scans of ``scan.py``; time in
milliseconds is the order, so a busy session is cut into pieces of a few minutes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railwatch.operators.scan import in_time_blocks, running
from railwatch.schemas import FINDING, LEAKAGE, LOOPING, PROMPT_INJECTION, REQUEST, RESPONSE

SESSION = ("agentId", "sessionId")
_SHIFTS = (18,)  # buckets of 262 seconds of milliseconds


def findings_around_requests(events: DataFrame, before_ms: int = 2_000, after_ms: int = 30_000) -> DataFrame:
    """Per request, the findings of its session in ``[request - before, request + after]``.

    Counted without forming pairs: a finding opens at ``t - after`` and closes just after
    ``t + before``; a request sees what is open at its own time.
    """
    t, finding = F.col("eventTimeMillis"), F.col("eventType") == FINDING
    fired = F.coalesce(F.col("triggered"), F.lit(False)).cast("int")
    mark = lambda at, n, f: F.struct(
        at.cast("long").alias("at"), F.lit(n).alias("open"), (fired * f).alias("openFired")
    )
    spans = F.when(finding, F.array(mark(t - after_ms, 1, 1), mark(t + before_ms + 1, -1, -1))).otherwise(
        F.array(mark(t, 0, 0))
    )
    marks = events.where(finding | (F.col("eventType") == REQUEST)).select(
        *SESSION, "requestId", "eventTimeMillis", (~finding).cast("int").alias("isRequest"), F.explode(spans).alias("m")
    ).select(*SESSION, "requestId", "eventTimeMillis", "isRequest", "m.*")
    seen = running(
        marks, "at", {"findings": ("sum", "open"), "triggeredFindings": ("sum", "openFired")}, SESSION,
        shifts=_SHIFTS, ties=("isRequest",),
    )
    return seen.where(F.col("isRequest") == 1).select(
        *SESSION, "requestId", "eventTimeMillis", "findings", "triggeredFindings"
    )


PAIR = (*SESSION, "requestId", "requestSeq", "requestMillis", "findingSeq", "findingMillis", "guardrailName", "triggered")


def request_sides(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests and findings with the columns that their pairs have, and their times as timestamps."""
    t = F.col("eventTimeMillis")
    return (
        events.where(F.col("eventType") == REQUEST).select(
            *SESSION, "requestId", F.col("seq").alias("requestSeq"), t.alias("requestMillis"), F.col("event_time").alias("requestTime")),
        events.where(F.col("eventType") == FINDING).select(
            *SESSION, F.col("seq").alias("findingSeq"), t.alias("findingMillis"), "guardrailName", "triggered", F.col("event_time").alias("findingTime")),
    )


def request_findings(events: DataFrame, before_ms: int = 2_000, after_ms: int = 30_000) -> DataFrame:
    """Pairs of a request and a finding of its session in ``[request - before, request + after]``.

    Joined by slices of time as wide as the interval: a request looks into the two that it touches, so
    a long session is spread over its slices.
    """
    width = before_ms + after_ms
    t = F.col("eventTimeMillis")
    asked = events.where(F.col("eventType") == REQUEST).select(
        *SESSION, "requestId", F.col("seq").alias("requestSeq"), t.alias("requestMillis"),
        F.explode(F.array_distinct(F.array(F.floor((t - before_ms) / width), F.floor((t + after_ms) / width)))).alias("slice"),
    )
    found = events.where(F.col("eventType") == FINDING).select(
        *SESSION, F.col("seq").alias("findingSeq"), t.alias("findingMillis"), "guardrailName", "triggered", F.floor(t / width).alias("slice")
    )
    near = F.col("findingMillis").between(F.col("requestMillis") - before_ms, F.col("requestMillis") + after_ms)
    return asked.join(found, [*SESSION, "slice"]).where(near).drop("slice")


def requests(events: DataFrame, key: str = "requestId") -> DataFrame:
    """The events of one request side by side; ``multiSignal`` when two guardrails fired."""
    kind, fired = F.col("eventType"), F.coalesce(F.col("triggered"), F.lit(False))
    return events.groupBy(*SESSION, key).agg(
        F.count_if(kind == REQUEST).alias("requests"), F.count_if(kind == RESPONSE).alias("responses"),
        F.count_if(kind == FINDING).alias("findings"),
        F.count_distinct(F.when(fired & (kind == FINDING), F.col("guardrailName"))).alias("firedGuardrails"),
        F.max(F.when(kind == FINDING, F.col("confidence"))).alias("maxConfidence"),
        F.min("eventTimeMillis").alias("firstEventTimeMillis"), F.max("eventTimeMillis").alias("lastEventTimeMillis"),
    ).withColumn("multiSignal", F.col("firedGuardrails") >= 2)


def enriched(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Events with the columns of an agent registry; unknown agents keep nulls.

    Spark broadcasts the registry only when its size allows it.
    """
    return events.join(registry, "agentId", "left")


def escalations(
    events: DataFrame, confidence: float = 0.8, output_tokens: int = 400, within_ms: int = 180_000
) -> DataFrame:
    """Two strong injections, then a leakage, then a high output, in order and in time.

    The latest leakage and, before it, the latest two injections give the shortest sequence,
    so three values carried forward decide each candidate row, in blocks of time that overlap by ``within_ms``.
    """
    t, fired = F.col("eventTimeMillis"), F.coalesce(F.col("triggered"), F.lit(False))
    injection = fired & (F.col("guardrailName") == PROMPT_INJECTION) & (F.col("confidence") >= confidence)
    leak = fired & (F.col("guardrailName") == LEAKAGE)
    rows = events.select(
        *SESSION, "seq", "requestId", "eventTimeMillis", "outputTokens",
        F.coalesce(injection, F.lit(False)).alias("injection"), F.coalesce(leak, F.lit(False)).alias("leak"),
    ).where(F.col("injection") | F.col("leak") | (F.col("outputTokens") >= output_tokens))
    rows = in_time_blocks(rows, "eventTimeMillis", within_ms)
    before = _ordered().rowsBetween(Window.unboundedPreceding, -1)
    latest = lambda flag, value: F.last(F.when(F.col(flag), value), ignorenulls=True).over(before)
    rows = rows.withColumn("previous", latest("injection", t))
    rows = rows.withColumn("pair", latest("injection", F.col("previous")))
    rows = rows.withColumn("startMillis", latest("leak", F.col("pair")))
    return rows.where(F.col("__own") & (F.col("outputTokens") >= output_tokens) & (t - F.col("startMillis") <= within_ms)).select(
        *SESSION, "requestId", "startMillis", "eventTimeMillis", "outputTokens"
    )


def _ordered():
    return Window.partitionBy(*SESSION, "__block").orderBy("eventTimeMillis", "seq")


def rising_injections(events: DataFrame, steps: int = 3, within_ms: int = 180_000) -> DataFrame:
    """The last of ``steps`` triggered injections of a session, one after the other, of rising confidence and in time.

    Other events between them do not matter; an injection of equal or lower confidence ends a rise, one
    without confidence is passed over.
    """
    if steps < 2:
        raise ValueError("a rise has two steps at least")
    fired = F.coalesce(F.col("triggered"), F.lit(False)) & (F.col("guardrailName") == PROMPT_INJECTION) & F.col("confidence").isNotNull()
    rows = in_time_blocks(
        events.where(fired).select(*SESSION, "seq", "requestId", "eventTimeMillis", "confidence"), "eventTimeMillis", within_ms)
    order = _ordered()
    back = [F.lag(F.struct("eventTimeMillis", "confidence"), k).over(order) for k in range(1, steps)]
    rows = rows.withColumns({f"__back{k + 1}": b for k, b in enumerate(back)})
    values = [F.col("confidence"), *[F.col(f"__back{k}.confidence") for k in range(1, steps)]]
    rises = reduce(lambda a, b: a & b, [later > earlier for later, earlier in zip(values, values[1:], strict=False)])
    first = F.col(f"__back{steps - 1}")
    return rows.where(F.col("__own") & rises & (F.col("eventTimeMillis") - first["eventTimeMillis"] <= within_ms)).select(
        *SESSION, "requestId", first["eventTimeMillis"].alias("startMillis"), "eventTimeMillis",
        first["confidence"].alias("firstConfidence"), F.col("confidence").alias("lastConfidence"),
    )


def runaway_agents(events: DataFrame, steps: int = 2, within_ms: int = 180_000) -> DataFrame:
    """A triggered looping finding, then a response followed by ``steps`` more, each with more output tokens than the one before.

    Given out at the last of these responses, all within ``within_ms`` of the latest such finding before the first of
    them.  Responses without a number of tokens are passed over.
    """
    if steps < 1:
        raise ValueError("growth has one step at least")
    looping = F.coalesce(F.col("triggered"), F.lit(False)) & (F.col("guardrailName") == LOOPING) & (F.col("eventType") == FINDING)
    response = (F.col("eventType") == RESPONSE) & F.col("outputTokens").isNotNull()
    rows = events.select(
        *SESSION, "seq", "requestId", "eventTimeMillis", "outputTokens", F.coalesce(looping, F.lit(False)).alias("looping"),
        F.coalesce(response, F.lit(False)).alias("response"),
    ).where("looping OR response")
    rows = in_time_blocks(rows, "eventTimeMillis", within_ms)
    before = _ordered().rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("loopAt", F.last(F.when(F.col("looping"), F.col("eventTimeMillis")), ignorenulls=True).over(before))
    # Each response carries those before it, so ``steps`` windows in one order reach the first.
    rows = rows.withColumn("grown0", F.struct("outputTokens", "loopAt"))
    for k in range(steps):
        earlier = F.last(F.when(F.col("response"), F.col(f"grown{k}")), ignorenulls=True).over(before)
        rows = rows.withColumn(f"grown{k + 1}", earlier)
    grows = reduce(lambda a, b: a & b, [F.col(f"grown{k}.outputTokens") > F.col(f"grown{k + 1}.outputTokens") for k in range(steps)])
    start = F.col(f"grown{steps}.loopAt")
    return rows.where(F.col("__own") & F.col("response") & grows & (F.col("eventTimeMillis") - start <= within_ms)).select(
        *SESSION, "requestId", start.alias("startMillis"), "eventTimeMillis",
        F.col(f"grown{steps}.outputTokens").alias("firstOutputTokens"), F.col("outputTokens").alias("lastOutputTokens"),
    )
