"""Fixed row layouts.  Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, guardrails, rules and severities of the data contract.
REQUEST = "AGENT_REQUEST"
RESPONSE = "AGENT_RESPONSE"
FINDING = "GUARDRAIL_FINDING"
EVENT_TYPES = (REQUEST, RESPONSE, FINDING)

PROMPT_INJECTION = "PROMPT_INJECTION"
TOXICITY = "TOXICITY"
LOOPING = "LOOPING"
LEAKAGE = "SYSTEM_PROMPT_LEAKAGE"
SCORED_GUARDRAILS = (PROMPT_INJECTION, TOXICITY)

BURST_RULE = "PROMPT_INJECTION_BURST"
TOXIC_RULE = "TOXICITY_CAMPAIGN"
LEAK_RULE = "LEAKAGE_WITH_INJECTION"
LOOP_RULE = "LOOPING_PERSISTENCE"
MIXED_RULE = "PI_AND_TOXIC"
SIMILAR_RULE = "SIMILAR_PROMPT_INJECTION_CAMPAIGN"
SESSION_RULES = (BURST_RULE, TOXIC_RULE, LEAK_RULE, LOOP_RULE, MIXED_RULE)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
STRINGS = T.ArrayType(S)

RAW = _struct(value=S, source=S, partition=I, seq=L)

# The payload is read with every field as text: coercion is then explicit and a wrong
# type in one field cannot void the whole row.
JSON_FIELDS = (
    "eventType", "agentId", "sessionId", "requestId", "eventTime", "tenantId", "environment",
    "turnId", "modelName", "userId", "channel", "inputTokens", "outputTokens", "guardrailName",
    "guardrailVersion", "policyVersion", "confidence", "triggered", "detectorLatencyMs",
    "detectorStatus", "evidenceSnippet",
)
CORRUPT = "_corrupt_record"
JSON_PAYLOAD = T.StructType([T.StructField(n, S, True) for n in (*JSON_FIELDS, CORRUPT)])

EVENT = _struct(
    tenantId=S, environment=S, agentId=S, sessionId=S, requestId=S, turnId=S,
    eventTimeMillis=L, eventType=S, modelName=S, userId=S, channel=S,
    inputTokens=I, outputTokens=I, guardrailName=S, guardrailVersion=S, policyVersion=S,
    confidence=D, triggered=B, detectorLatencyMs=L, detectorStatus=S, evidenceSnippet=S,
    rawPayload=S,
)
EVENT_FIELDS = tuple(EVENT.fieldNames())
ARRIVAL = ("source", "partition", "seq")
# The common order of several logs: when a message reached its log, then the log, its partition and the offset there.
TIME_LINE = ("ingestMillis", "source", "partition", "seq")

GUARDRAIL_POLICY = _struct(medium=D, high=D, critical=D, severity=S)
POLICY_BLOCK = _struct(
    promptInjection=GUARDRAIL_POLICY, toxicity=GUARDRAIL_POLICY,
    looping=GUARDRAIL_POLICY, systemPromptLeakage=GUARDRAIL_POLICY,
)
POLICY_SECTIONS = tuple(POLICY_BLOCK.fieldNames())
POLICY = _struct(
    version=S, updatedBy=S, updatedAt=S, defaults=POLICY_BLOCK,
    agents=T.MapType(S, POLICY_BLOCK),
)

INCIDENT = _struct(
    incidentId=S, tenantId=S, agentId=S, sessionId=S, ruleName=S, severity=S,
    requestIds=STRINGS, guardrailNames=STRINGS, guardrailVersions=STRINGS,
    policyVersions=STRINGS, sessionIds=STRINGS, evidenceSnippets=STRINGS,
    embeddingModelVersion=S, appliedPolicyVersion=S, firstEventTimeMillis=L,
    lastEventTimeMillis=L, emittedAtEventTimeMillis=L, triggeredFindingsCount=L,
    emissionRevision=I, summary=S,
)
INCIDENT_FIELDS = tuple(INCIDENT.fieldNames())

AGGREGATE_KEY = ("agentId", "guardrailName", "guardrailVersion", "policyVersion", "modelName")
