"""Small builders for events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.schemas import EVENT

SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("seq", T.LongType()), *EVENT.fields,
])
BASE = 1_787_745_600_000
VERSIONS = {"PROMPT_INJECTION": "pi-v1", "TOXICITY": "tox-v1", "LOOPING": "loop-v1", "SYSTEM_PROMPT_LEAKAGE": "spl-v1"}


def finding(seq, t, guardrail="PROMPT_INJECTION", confidence=None, triggered=True, **other):
    row = dict.fromkeys(SCHEMA.fieldNames())
    row.update(
        source="findings", partition=0, seq=seq, tenantId="tenant-a", agentId="agent-1", sessionId="session-1",
        requestId=f"req-{seq}", eventTimeMillis=BASE + t, eventType="GUARDRAIL_FINDING", inputTokens=100,
        outputTokens=50, guardrailName=guardrail, guardrailVersion=VERSIONS.get(guardrail), policyVersion="policy-v1",
        modelName="model-1", confidence=confidence, triggered=triggered, detectorLatencyMs=10, detectorStatus="OK",
    )
    row.update(other)
    return row


def events(spark, rows):
    frame = spark.createDataFrame([tuple(r[c] for c in SCHEMA.fieldNames()) for r in rows], SCHEMA)
    return frame.withColumn("event_time", F.timestamp_millis("eventTimeMillis"))
