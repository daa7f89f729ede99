"""The same queries in DuckDB SQL, for checking.

Written from the definition of each result and from the table columns, never from the JSON
or YAML text, so that a fault in a reader shows.  Lists compare as text.
"""

from __future__ import annotations

from railwatch.plans.catalog import EMITTED_AT_MS
from railwatch.sources.tables import EVIDENCE_BURST, POLICY_T0_SECONDS, REQUESTS_PER_USER, T0_MILLIS

ORACLES: dict[str, str] = {}

BOOTSTRAP_SECONDS = POLICY_T0_SECONDS - 6 * 86_400

# One row per table event, with the fields that survive the injected faults.
NORM = f"""
bursts AS (
  SELECT e.*, CASE WHEN event_type = 'error' THEN (event_id // {EVIDENCE_BURST}) % (SELECT max(conv_id) + 1 FROM conversations) END AS burst
  FROM events e
), spoken AS (
  SELECT b.*, c.text AS evidence FROM bursts b
  LEFT JOIN (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id) n ON n.conv_id = b.burst
  LEFT JOIN conversations c ON c.conv_id = b.burst AND c.turn = b.event_id % n.turns
), base AS (
  SELECT event_id AS seq, user_id, event_type AS kind, value, evidence,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
    CAST({T0_MILLIS} + (epoch_us(ts) - {T0_MILLIS}000) // 240000 AS BIGINT) AS ms0,
    (CAST(round(value * 100) AS BIGINT) % 10000) / 10000.0::DOUBLE AS score
  FROM spoken
), norm AS (
  SELECT seq,
    CASE WHEN kind <> 'click' THEN 'guardrail-findings' WHEN seq % 2 = 0 THEN 'agent-requests'
         ELSE 'agent-responses' END AS source,
    CAST(user_id % 3 AS INTEGER) AS "partition",
    'tenant-' || (user_id % 8) AS "tenantId", 'agent-' || (user_id % 4) AS "agentId",
    CASE WHEN k <> 9 THEN 'session-' || user_id END AS "sessionId",
    'req-' || user_id || '-' || (seq % {REQUESTS_PER_USER}) AS "requestId", 'turn-' || seq AS "turnId",
    CASE WHEN k <> 10 THEN ms0 - CASE k WHEN 7 THEN 45000 WHEN 8 THEN 360000 ELSE 0 END END
      AS "eventTimeMillis",
    CASE WHEN k = 14 THEN 'AGENT_PING' WHEN kind <> 'click' THEN 'GUARDRAIL_FINDING'
         WHEN seq % 2 = 0 THEN 'AGENT_REQUEST' ELSE 'AGENT_RESPONSE' END AS "eventType",
    'gpt-4.1-mini' AS "modelName", 'user-' || user_id AS "userId", 'web' AS channel,
    CAST(150 + seq % 120 AS INTEGER) AS "inputTokens",
    CAST(250 + seq % 220 AS INTEGER) AS "outputTokens",
    CASE WHEN k = 11 THEN NULL WHEN kind = 'error' THEN 'PROMPT_INJECTION'
         WHEN kind = 'purchase' THEN 'TOXICITY' WHEN kind = 'signup' THEN 'LOOPING'
         WHEN kind = 'view' THEN 'SYSTEM_PROMPT_LEAKAGE' END AS "guardrailName",
    CASE kind WHEN 'error' THEN 'pi-v1' WHEN 'purchase' THEN 'tox-v1' WHEN 'signup' THEN 'loop-v1'
         WHEN 'view' THEN 'spl-v1' END AS "guardrailVersion",
    'policy-v1' AS "policyVersion",
    CASE WHEN k <> 12 AND kind IN ('error', 'purchase') THEN score END AS confidence,
    CASE WHEN k <> 13 AND kind <> 'click' THEN score >= 0.40 END AS triggered,
    CAST(5 + k AS BIGINT) AS "detectorLatencyMs",
    CASE WHEN k % 12 = 0 THEN 'ERROR' ELSE 'OK' END AS "detectorStatus",
    evidence AS "evidenceSnippet", ms0 AS "ingestMillis",
    CASE
      WHEN k = 15 THEN 'PARSE_ERROR'
      WHEN k = 14 THEN 'UNSUPPORTED_EVENT_TYPE'
      WHEN k = 9 THEN 'MISSING_FIELD'
      WHEN k = 10 THEN 'BAD_EVENT_TIME'
      WHEN k = 11 AND kind <> 'click' THEN 'MISSING_GUARDRAIL_NAME'
      WHEN k = 12 AND kind IN ('error', 'purchase') THEN 'MISSING_CONFIDENCE'
      WHEN k = 13 AND kind <> 'click' THEN 'MISSING_TRIGGERED'
    END AS reason_code
  FROM base
)"""

ROUTED = NORM + """, marked AS (
  SELECT *, max("eventTimeMillis") OVER (
      PARTITION BY source, "partition" ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30001 AS watermark
  FROM norm WHERE reason_code IS NULL
), routed AS (
  SELECT *, coalesce("eventTimeMillis" + 300000 < watermark, false) AS late FROM marked
), ev AS (SELECT * FROM routed WHERE NOT late)"""

_EVENT_COLUMNS = """seq, source, "partition", "tenantId", CAST(NULL AS VARCHAR) AS environment,
  "agentId", "sessionId", "requestId", "turnId", "eventTimeMillis", "eventType", "modelName",
  "userId", channel, "inputTokens", "outputTokens", "guardrailName", "guardrailVersion",
  "policyVersion", confidence, triggered, "detectorLatencyMs", "detectorStatus", "evidenceSnippet\""""

ORACLES["parse_events"] = f"WITH {NORM} SELECT {_EVENT_COLUMNS} FROM norm WHERE reason_code IS NULL"

ORACLES["invalid_events"] = f"""WITH {NORM}
SELECT source, "partition", seq, reason_code, CASE reason_code
  WHEN 'PARSE_ERROR' THEN 'Parse error: malformed JSON'
  WHEN 'UNSUPPORTED_EVENT_TYPE' THEN 'Unsupported eventType: AGENT_PING'
  WHEN 'MISSING_FIELD' THEN 'Unsupported eventType: Missing required field: sessionId'
  WHEN 'BAD_EVENT_TIME' THEN 'Parse error: unreadable eventTime yesterday'
  WHEN 'MISSING_GUARDRAIL_NAME' THEN 'Missing required field: guardrailName'
  WHEN 'MISSING_CONFIDENCE' THEN 'Missing required confidence for confidence-based guardrail'
  ELSE 'Missing required triggered field for guardrail finding' END AS reason
FROM norm WHERE reason_code IS NOT NULL"""

ORACLES["on_time_events"] = f"""WITH {ROUTED}
SELECT source, "partition", seq, "eventTimeMillis", "eventType", "requestId" FROM ev"""

ORACLES["late_events"] = f"""WITH {ROUTED}
SELECT source, "partition", seq, 'Event is older than current watermark tolerance' AS reason,
  watermark AS "currentWatermark", "eventTimeMillis", "requestId"
FROM routed WHERE late"""

FIRED = ROUTED + """, fired AS (
  SELECT * FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING' AND triggered)"""

ORACLES["triggered_findings"] = f"""WITH {FIRED}
SELECT seq, "agentId", "sessionId", "guardrailName", confidence FROM fired"""

ORACLES["evidence_findings"] = f"""WITH {FIRED}
SELECT seq, "agentId", "evidenceSnippet" FROM fired
WHERE "guardrailName" = 'PROMPT_INJECTION' AND trim("evidenceSnippet") <> ''"""

ORACLES["events_to_json"] = f"""WITH {ROUTED}
SELECT "requestId", "eventType", CAST("eventTimeMillis" AS VARCHAR) AS "eventTimeMillis",
  CAST(triggered AS VARCHAR) AS triggered, true AS "nullsWritten" FROM ev"""

# --- window aggregates --------------------------------------------------------------------


def _agg(sizes: str = "(60000), (300000)", source: str = "ev", name: str = "agg") -> str:
    scored = "\"guardrailName\" IN ('PROMPT_INJECTION', 'TOXICITY')"
    disc = lambda q, extra: (
        f"CASE WHEN {scored} THEN quantile_disc(confidence, {q}) FILTER (WHERE confidence IS NOT NULL{extra}) END"
    )
    key = '"agentId", "guardrailName", "guardrailVersion", "policyVersion", "modelName"'
    return f"""{name} AS (
  SELECT first("tenantId" ORDER BY seq) AS "tenantId", {key},
    CASE size WHEN 60000 THEN '1m' ELSE '5m' END AS "windowName",
    "eventTimeMillis" // size * size AS "windowStartMillis",
    "eventTimeMillis" // size * size + size AS "windowEndMillis",
    max("eventTimeMillis") AS "latestEventTimeMillis",
    count(*) AS "totalEvents", count(*) AS "guardrailFindingCount",
    count(*) FILTER (WHERE triggered) AS "triggeredCount",
    count(*) FILTER (WHERE triggered AND "guardrailName" = 'LOOPING') AS "loopingTriggeredCount",
    count(*) FILTER (WHERE triggered AND "guardrailName" = 'SYSTEM_PROMPT_LEAKAGE')
      AS "systemPromptLeakageTriggeredCount",
    CAST(sum("inputTokens") AS BIGINT) AS "inputTokens",
    CAST(sum("outputTokens") AS BIGINT) AS "outputTokens",
    count(confidence) AS "confidenceCount", min(confidence) AS "minConfidence",
    avg(confidence) AS "avgConfidence", max(confidence) AS "maxConfidence",
    {disc(0.5, "")} AS "p50Confidence", {disc(0.95, "")} AS "p95Confidence",
    {disc(0.5, " AND triggered")} AS "triggeredP50Confidence",
    {disc(0.95, " AND triggered")} AS "triggeredP95Confidence",
    min("detectorLatencyMs") AS "minDetectorLatencyMs",
    avg("detectorLatencyMs") AS "avgDetectorLatencyMs",
    max("detectorLatencyMs") AS "maxDetectorLatencyMs",
    count(*) FILTER (WHERE upper("detectorStatus") <> 'OK') AS "detectorErrorCount"
  FROM {source}, (VALUES {sizes}) AS s(size)
  WHERE "eventType" = 'GUARDRAIL_FINDING'
  GROUP BY {key}, size, "eventTimeMillis" // size
)"""


_AVERAGES = """* REPLACE (round("avgConfidence", 12) AS "avgConfidence",
  round("avgDetectorLatencyMs", 12) AS "avgDetectorLatencyMs")"""
AGG = ROUTED + ", " + _agg()
ORACLES["guardrail_agg_1m"] = f"WITH {ROUTED}, {_agg('(60000)')} SELECT {_AVERAGES} FROM agg"
ORACLES["guardrail_agg_5m"] = f"WITH {ROUTED}, {_agg('(300000)')} SELECT {_AVERAGES} FROM agg"
ORACLES["guardrail_agg_all"] = f"WITH {AGG} SELECT {_AVERAGES} FROM agg"
ORACLES["guardrail_agg_compact"] = ORACLES["guardrail_agg_all"]
# The last revision of a window is the one over all its rows.
ORACLES["latest_aggregates"] = ORACLES["guardrail_agg_all"]

_E2E = f"""greatest(0, {EMITTED_AT_MS} - "latestEventTimeMillis") AS "e2eLatestEventToEmitMs",
  greatest(0, {EMITTED_AT_MS} - "windowEndMillis") AS "e2eWindowEndToEmitMs\""""
ORACLES["emit_latency"] = f"""WITH {AGG}
SELECT "agentId", "guardrailName", "guardrailVersion", "policyVersion", "modelName", "windowName",
  "windowStartMillis", "latestEventTimeMillis", {_E2E} FROM agg"""

QUALITY = AGG + f""", quality AS (
  SELECT "tenantId", "agentId", "guardrailName", "guardrailVersion", "policyVersion", "modelName",
    "windowName", "windowStartMillis", "windowEndMillis", "latestEventTimeMillis",
    "guardrailFindingCount", "triggeredCount",
    "triggeredCount" / "guardrailFindingCount"::DOUBLE AS "triggerRate",
    "detectorErrorCount",
    "detectorErrorCount" / "guardrailFindingCount"::DOUBLE AS "detectorErrorRate",
    CASE WHEN scored THEN "guardrailFindingCount" - "confidenceCount" END AS "missingConfidenceCount",
    CASE WHEN scored THEN ("guardrailFindingCount" - "confidenceCount") / "guardrailFindingCount"::DOUBLE
      END AS "missingConfidenceRate",
    CASE WHEN scored THEN "confidenceCount" / "guardrailFindingCount"::DOUBLE END
      AS "confidenceCoverageRate",
    "confidenceCount", "minDetectorLatencyMs", "avgDetectorLatencyMs", "maxDetectorLatencyMs",
    {_E2E}
  FROM (SELECT *, "guardrailName" IN ('PROMPT_INJECTION', 'TOXICITY') AS scored FROM agg)
)"""
ORACLES["guardrail_quality"] = f"""WITH {QUALITY}
SELECT * REPLACE (
  round("triggerRate", 12) AS "triggerRate", round("detectorErrorRate", 12) AS "detectorErrorRate",
  round("missingConfidenceRate", 12) AS "missingConfidenceRate",
  round("confidenceCoverageRate", 12) AS "confidenceCoverageRate",
  round("avgDetectorLatencyMs", 12) AS "avgDetectorLatencyMs") FROM quality"""

# --- policies -----------------------------------------------------------------------------

# A supplier row gives the values that the YAML text carries.  The decision is the literal
# sequential one: a recursion over the updates that keeps the last accepted policy.
POLICIES = f"""
sup AS (
  SELECT s_suppkey AS i, s_nationkey AS nation,
    ((CAST(round(s_acctbal * 100) AS BIGINT) % 1000) + 1000) % 1000 AS c
  FROM supplier
), pol AS (
  SELECT i, i * 100 + 50 AS seq,
    NOT (nation % 7 = 6 OR (nation % 7 = 5 AND i % 2 = 1)) AS valid,
    'policy-v' || lpad(CAST(c AS VARCHAR), 3, '0') || '-' || i AS version,
    CASE WHEN nation % 5 <> 0 THEN {POLICY_T0_SECONDS} + (i * 10 + c % 61 - 30) * 60 END AS upd,
    (60 + c % 30) / 100.0::DOUBLE AS pi_high, (85 + c % 10) / 100.0::DOUBLE AS pi_critical,
    (50 + c % 45) / 100.0::DOUBLE AS tox_high,
    ['MEDIUM', 'HIGH', 'CRITICAL'][i % 3 + 1] AS looping,
    'agent-' || (i % 4) AS agent, (50 + c % 40) / 100.0::DOUBLE AS agent_high,
    CASE WHEN i % 2 = 0 THEN (80 + c % 15) / 100.0::DOUBLE END AS agent_critical,
    CAST(NULL AS DOUBLE) AS tox_medium
  FROM sup
)"""
ORACLES["parse_policies"] = f"""WITH {POLICIES}
SELECT seq, valid, CASE WHEN valid THEN version END AS version,
  CASE WHEN valid THEN strftime(make_timestamp(upd * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS "updatedAt",
  CASE WHEN valid THEN pi_high END AS "piHigh", CASE WHEN valid THEN tox_high END AS "toxicityHigh",
  CASE WHEN valid THEN looping END AS "loopingSeverity", CASE WHEN valid THEN agent END AS agents
FROM pol"""

DECIDED = POLICIES + f""", line AS (
  SELECT *, row_number() OVER (ORDER BY seq) AS n FROM pol WHERE valid
), fold AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS seq, 'base-0' AS version, true AS accepted,
    CAST(NULL AS VARCHAR) AS rejection, CAST({BOOTSTRAP_SECONDS} AS BIGINT) AS cur_at, 'base-0' AS cur_version
  UNION ALL
  SELECT l.n, l.seq, l.version,
    NOT (coalesce(l.upd < f.cur_at, false) OR (l.upd IS NULL AND f.cur_at IS NULL AND l.version < f.cur_version)),
    CASE WHEN l.upd < f.cur_at THEN 'older-updatedAt'
         WHEN l.upd IS NULL AND f.cur_at IS NULL AND l.version < f.cur_version THEN 'older-version' END,
    CASE WHEN coalesce(l.upd < f.cur_at, false) OR (l.upd IS NULL AND f.cur_at IS NULL AND l.version < f.cur_version)
         THEN f.cur_at ELSE l.upd END,
    CASE WHEN coalesce(l.upd < f.cur_at, false) OR (l.upd IS NULL AND f.cur_at IS NULL AND l.version < f.cur_version)
         THEN f.cur_version ELSE l.version END
  FROM fold f JOIN line l ON l.n = f.n + 1
)"""
_R = "WITH RECURSIVE"
ORACLES["accepted_policies"] = f"{_R} {DECIDED} SELECT seq, version, accepted, rejection FROM fold"

TIMELINE = DECIDED + """, line_of AS (
  SELECT f.seq, f.version, coalesce(p.pi_high, 0.75) AS pi_high, coalesce(p.pi_critical, 0.90) AS pi_critical,
    CASE WHEN f.seq < 0 THEN 0.70 END AS tox_medium, coalesce(p.tox_high, 0.90) AS tox_high,
    coalesce(p.looping, 'MEDIUM') AS looping, coalesce(p.agent, 'agent-0') AS agent,
    CASE WHEN f.seq < 0 THEN 0.68 ELSE p.agent_high END AS agent_high,
    CASE WHEN f.seq < 0 THEN 0.93 ELSE p.agent_critical END AS agent_critical
  FROM fold f LEFT JOIN pol p ON p.seq = f.seq WHERE f.accepted
), timeline AS (SELECT *, lead(seq) OVER (ORDER BY seq) AS until FROM line_of)"""
ORACLES["effective_policy"] = f"""{_R} {TIMELINE}
SELECT seq, version, "agentId", CAST(0.55 AS DOUBLE) AS "promptInjection_medium",
  CAST(CASE WHEN own THEN coalesce(agent_high, pi_high) ELSE pi_high END AS DOUBLE) AS "promptInjection_high",
  CAST(CASE WHEN own THEN coalesce(agent_critical, pi_critical) ELSE pi_critical END AS DOUBLE)
    AS "promptInjection_critical",
  CAST(tox_medium AS DOUBLE) AS toxicity_medium, CAST(tox_high AS DOUBLE) AS toxicity_high,
  CAST(NULL AS DOUBLE) AS toxicity_critical,
  looping AS looping_severity, 'CRITICAL' AS "systemPromptLeakage_severity"
FROM (SELECT *, '*' AS "agentId", false AS own FROM timeline
      UNION ALL SELECT *, agent AS "agentId", true AS own FROM timeline)"""

_LIMITS = """t.version AS "appliedPolicyVersion",
    CAST(CASE WHEN t.agent = x."agentId" THEN coalesce(t.agent_high, t.pi_high) ELSE t.pi_high END AS DOUBLE)
      AS "piHigh",
    CAST(CASE WHEN t.agent = x."agentId" THEN coalesce(t.agent_critical, t.pi_critical) ELSE t.pi_critical
      END AS DOUBLE) AS "piCritical",
    CAST(t.tox_high AS DOUBLE) AS "toxicityHigh", t.looping AS "loopingSeverity\""""
_IN_FORCE = "JOIN timeline t ON x.seq >= t.seq AND (t.until IS NULL OR x.seq < t.until)"
ORACLES["policy_asof"] = f"""{_R} {FIRED}, {TIMELINE}
SELECT x.seq, x."agentId", {_LIMITS} FROM fired x {_IN_FORCE}"""

# The same policies as messages of two partitions: their rank in the order of all logs takes the place of their number.
_TOPIC = TIMELINE.replace("SELECT i, i * 100 + 50 AS seq,", f"""SELECT i, {T0_MILLIS} + i * 7919000 % 10800000 AS ingest, i % 2 AS part, i // 2 AS off,
    row_number() OVER (ORDER BY {T0_MILLIS} + i * 7919000 % 10800000, i % 2, i // 2) AS seq,""")
ORACLES["policy_asof_topics"] = f"""{_R} {FIRED}, {_TOPIC}, placed AS (
  SELECT t.*, coalesce(p.ingest, -1) AS ingest, coalesce(p.part, -1) AS part, coalesce(p.off, -1) AS off FROM timeline t LEFT JOIN pol p ON p.seq = t.seq
)
SELECT x.seq, x."agentId", {_LIMITS} FROM fired x
JOIN placed t ON t.ingest < x."ingestMillis" OR (t.ingest = x."ingestMillis" AND 'policy-updates' < x.source)
QUALIFY row_number() OVER (PARTITION BY x.seq ORDER BY t.seq DESC) = 1"""

ORACLES["report_policy_updates"] = f"""{_R} {DECIDED}
SELECT (SELECT count(*) FROM fold WHERE accepted AND seq >= 0) AS "acceptedUpdates",
  (SELECT count(*) FROM fold WHERE NOT accepted) AS "rejectedUpdates",
  (SELECT coalesce(CASE WHEN f.seq < 0 THEN {POLICY_T0_SECONDS} ELSE p.upd END, 0) * 1000
     FROM fold f LEFT JOIN pol p ON p.seq = f.seq WHERE f.accepted ORDER BY f.seq DESC LIMIT 1)
    AS "lastUpdateEpochMs",
  (SELECT count(*) FROM pol WHERE NOT valid) AS "invalidUpdates\""""

# --- sessions -----------------------------------------------------------------------------

STATE = FIRED + """, gaps AS (
  SELECT *, "eventTimeMillis" AS t, "eventTimeMillis" - lag("eventTimeMillis") OVER (
      PARTITION BY "agentId", "sessionId" ORDER BY "eventTimeMillis", seq) AS gap
  FROM fired
), epochs AS (
  SELECT *, CAST(sum(CASE WHEN gap > 1800000 THEN 1 ELSE 0 END) OVER (
      PARTITION BY "agentId", "sessionId" ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch
  FROM gaps
), state AS (
  SELECT *, first_value(t) OVER w AS first_t, count(*) OVER w AS n_all,
    count(*) FILTER (WHERE "guardrailName" = 'PROMPT_INJECTION') OVER w AS n_pi,
    count(*) FILTER (WHERE "guardrailName" = 'TOXICITY') OVER w AS n_tox,
    count(*) FILTER (WHERE "guardrailName" = 'LOOPING') OVER w AS n_loop,
    count(*) FILTER (WHERE "guardrailName" = 'SYSTEM_PROMPT_LEAKAGE') OVER w AS n_leak,
    coalesce(max(confidence) FILTER (WHERE "guardrailName" = 'PROMPT_INJECTION') OVER w, -1) AS max_pi,
    coalesce(max(confidence) FILTER (WHERE "guardrailName" = 'TOXICITY') OVER w, -1) AS max_tox
  FROM epochs
  WINDOW w AS (PARTITION BY "agentId", "sessionId", epoch ORDER BY t, seq ROWS UNBOUNDED PRECEDING)
), seen AS (
  SELECT a.seq, count(*) FILTER (WHERE b."guardrailName" = 'PROMPT_INJECTION') AS win_pi,
    count(*) FILTER (WHERE b."guardrailName" = 'TOXICITY') AS win_tox,
    coalesce(max(b.confidence) FILTER (WHERE b."guardrailName" = 'PROMPT_INJECTION'), -1) AS winmax_pi,
    coalesce(max(b.confidence) FILTER (WHERE b."guardrailName" = 'TOXICITY'), -1) AS winmax_tox
  FROM state a JOIN state b ON a."agentId" = b."agentId" AND a."sessionId" = b."sessionId"
    AND b.t BETWEEN a.t - 300000 AND a.t AND (b.t, b.seq) <= (a.t, a.seq)
  GROUP BY a.seq
), full_state AS (SELECT * FROM state JOIN seen USING (seq))"""

ORACLES["session_state"] = f"""WITH {STATE}
SELECT seq, "agentId", "sessionId", first_t AS "firstEventTimeMillis", n_all, n_pi, n_tox, n_loop, n_leak,
  max_pi, max_tox, win_pi, win_tox, winmax_pi, winmax_tox FROM full_state"""

_EPOCHS = """SELECT "agentId", "sessionId", epoch, min(t) AS "firstEventTimeMillis",
  max(t) AS "lastEventTimeMillis", count(*) AS "triggeredFindingsCount",
  count(*) FILTER (WHERE "guardrailName" = 'PROMPT_INJECTION') AS "promptInjectionCount",
  count(*) FILTER (WHERE "guardrailName" = 'TOXICITY') AS "toxicityCount",
  count(*) FILTER (WHERE "guardrailName" = 'LOOPING') AS "loopingCount",
  count(*) FILTER (WHERE "guardrailName" = 'SYSTEM_PROMPT_LEAKAGE') AS "systemPromptLeakageCount",
  max(confidence) FILTER (WHERE "guardrailName" = 'PROMPT_INJECTION') AS "maxPromptInjectionConfidence",
  max(confidence) FILTER (WHERE "guardrailName" = 'TOXICITY') AS "maxToxicityConfidence"
FROM epochs GROUP BY "agentId", "sessionId", epoch"""
ORACLES["session_epochs"] = f"WITH {STATE} {_EPOCHS}"
ORACLES["open_sessions"] = f"""WITH {STATE}, lives AS ({_EPOCHS})
SELECT "agentId", "sessionId", "firstEventTimeMillis", "lastEventTimeMillis" FROM lives
WHERE "lastEventTimeMillis" + 1800000 > {T0_MILLIS + 175 * 60_000}"""


def _three(c: str) -> str:
    """Three digits, halves up, of a value with four."""
    m = f"((CAST(round({c} * 10000) AS BIGINT) + 5) // 10)"
    return f"CASE WHEN {c} < 0 THEN 'n/a' ELSE printf('%d.%03d', {m} // 1000, {m} % 1000) END"


def _incidents(updates: bool) -> str:
    def values(column: str, cap: str = "") -> str:
        # Distinct values up to the emitting row, in first-seen order.
        return f"""(SELECT string_agg(v, ',' ORDER BY ft, fs) FROM (
            SELECT v, ft, fs FROM (
              SELECT "{column}" AS v, min(t) AS ft, first(seq ORDER BY t, seq) AS fs FROM epochs y
              WHERE y."agentId" = x."agentId" AND y."sessionId" = x."sessionId" AND y.epoch = x.epoch
                AND (y.t, y.seq) <= (x.t, x.seq) GROUP BY 1)
            ORDER BY ft, fs {cap}))"""

    return f"""{STATE}, {TIMELINE}, hits AS (
  SELECT *, 'PROMPT_INJECTION_BURST' AS rule FROM full_state
    WHERE "guardrailName" = 'PROMPT_INJECTION' AND n_pi >= 3
  UNION ALL SELECT *, 'TOXICITY_CAMPAIGN' FROM full_state
    WHERE "guardrailName" = 'TOXICITY' AND n_tox >= 3
  UNION ALL SELECT *, 'LEAKAGE_WITH_INJECTION' FROM full_state
    WHERE "guardrailName" IN ('PROMPT_INJECTION', 'SYSTEM_PROMPT_LEAKAGE') AND n_pi >= 1 AND n_leak >= 1
  UNION ALL SELECT *, 'LOOPING_PERSISTENCE' FROM full_state
    WHERE "guardrailName" = 'LOOPING' AND n_loop >= 2
  UNION ALL SELECT *, 'PI_AND_TOXIC' FROM full_state
    WHERE "guardrailName" IN ('PROMPT_INJECTION', 'TOXICITY') AND win_pi >= 1 AND win_tox >= 1
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY "agentId", "sessionId", epoch, rule ORDER BY t, seq) AS revision
  FROM hits
), x AS (SELECT * FROM numbered {"" if updates else "WHERE revision = 1"}
), limited AS (SELECT x.*, {_LIMITS} FROM x {_IN_FORCE}
), incidents AS (
  SELECT "agentId" || '|' || "sessionId" || '|' || rule || '|' || first_t AS "incidentId",
    "tenantId", "agentId", "sessionId", rule AS "ruleName",
    CASE rule
      WHEN 'PROMPT_INJECTION_BURST' THEN CASE WHEN max_pi >= "piHigh" THEN 'HIGH' ELSE 'MEDIUM' END
      WHEN 'TOXICITY_CAMPAIGN' THEN CASE WHEN max_tox >= "toxicityHigh" THEN 'HIGH' ELSE 'MEDIUM' END
      WHEN 'LEAKAGE_WITH_INJECTION' THEN CASE WHEN max_pi >= "piCritical" THEN 'CRITICAL' ELSE 'HIGH' END
      WHEN 'LOOPING_PERSISTENCE' THEN
        CASE WHEN n_loop >= 4 AND "loopingSeverity" = 'MEDIUM' THEN 'HIGH' ELSE "loopingSeverity" END
      ELSE 'HIGH' END AS severity,
    {values("requestId", "")} AS "requestIds",
    {values("guardrailName")} AS "guardrailNames",
    {values("guardrailVersion")} AS "guardrailVersions",
    {values("policyVersion")} AS "policyVersions",
    '' AS "sessionIds", '' AS "evidenceSnippets", CAST(NULL AS VARCHAR) AS "embeddingModelVersion",
    "appliedPolicyVersion", first_t AS "firstEventTimeMillis", t AS "lastEventTimeMillis",
    t AS "emittedAtEventTimeMillis", n_all AS "triggeredFindingsCount",
    CAST(revision AS INTEGER) AS "emissionRevision",
    CASE rule
      WHEN 'PROMPT_INJECTION_BURST' THEN 'Prompt injection burst detected: findings=' || n_pi
        || ', maxConfidence=' || {_three("max_pi")}
      WHEN 'TOXICITY_CAMPAIGN' THEN 'Toxicity campaign detected: findings=' || n_tox
        || ', maxConfidence=' || {_three("max_tox")}
      WHEN 'LEAKAGE_WITH_INJECTION' THEN
        'Prompt injection combined with system prompt leakage: promptInjectionFindings=' || n_pi
        || ', leakageFindings=' || n_leak
      WHEN 'LOOPING_PERSISTENCE' THEN 'Looping persistence detected: occurrences=' || n_loop
      ELSE 'PI_AND_TOXIC detected: promptInjectionFindings=' || win_pi || ', toxicityFindings=' || win_tox
        || ', maxPromptInjectionConfidence=' || {_three("winmax_pi")}
        || ', maxToxicityConfidence=' || {_three("winmax_tox")} END AS summary
  FROM limited x
)"""


INCIDENTS, UPDATES = _incidents(False), _incidents(True)
ORACLES["session_incidents"] = f"{_R} {INCIDENTS} SELECT * FROM incidents"
ORACLES["incident_updates"] = f"{_R} {UPDATES} SELECT * FROM incidents"
for _entry, _rule in (
    ("incident_pi_burst", "PROMPT_INJECTION_BURST"), ("incident_toxicity_campaign", "TOXICITY_CAMPAIGN"),
    ("incident_leakage_with_injection", "LEAKAGE_WITH_INJECTION"),
    ("incident_looping_persistence", "LOOPING_PERSISTENCE"), ("incident_pi_and_toxic", "PI_AND_TOXIC"),
):
    ORACLES[_entry] = f"{_R} {INCIDENTS} SELECT * FROM incidents WHERE \"ruleName\" = '{_rule}'"

# --- campaigns ----------------------------------------------------------------------------

# The hash embedding from its definition: polynomial string hash, two places per word.
# Length and parts are single precision; a quotient of such numbers in double rounds to the same.
def _vectors(key: str, texts: str) -> str:
    return f"""words AS (
  SELECT {key}, unnest(regexp_split_to_array(trim(text, ' \t\n\x0b\f\r'), '[ \t\n\x0b\f\r]+')) AS raw FROM (
    SELECT {key}, lower('query: ' || text) AS text FROM {texts})
), concepts AS (
  SELECT {key}, CASE
    WHEN raw IN ('ignore', 'disregard', 'bypass') THEN 'override'
    WHEN raw IN ('earlier', 'prior', 'previous') THEN 'previous'
    WHEN raw IN ('reveal', 'show', 'disclose') THEN 'reveal'
    WHEN raw IN ('prompt', 'message') THEN 'prompt'
    WHEN raw IN ('instructions', 'rules') THEN 'instructions' ELSE raw END AS word FROM words
), hashed AS (
  SELECT {key}, length(word) AS len,
    list_reduce(list_prepend(CAST(0 AS BIGINT), [CAST(ord(ch) AS BIGINT) for ch in string_split(word, '')]),
      lambda a, b: (a * 31 + b) % 4294967296) AS h
  FROM concepts
), places AS (
  SELECT {key}, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS v, 1.0 AS w FROM hashed
  UNION ALL
  SELECT {key}, CASE WHEN (h * 31 + len) % 4294967296 >= 2147483648
    THEN (h * 31 + len) % 4294967296 - 4294967296 ELSE (h * 31 + len) % 4294967296 END, 0.5 FROM hashed
), summed AS (
  SELECT {key}, ((v % 384) + 384) % 384 AS pos, CAST(sum(w) AS DOUBLE) AS x FROM places GROUP BY 1, 2
), vectors AS (
  SELECT {key}, CAST(pos AS BIGINT) AS pos, CAST(CAST(x / n AS FLOAT) AS DOUBLE) AS x FROM (
    SELECT *, CAST(CAST(sqrt(sum(x * x) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS n FROM summed))"""


ORACLES["hash_embedding"] = f"""WITH {FIRED}, texts AS (
  SELECT seq, "evidenceSnippet" AS text FROM fired WHERE "guardrailName" = 'PROMPT_INJECTION'
), {_vectors("seq", "texts")}
SELECT seq, pos, round(x, 5) AS x FROM vectors"""


def _campaign_windows(mode: str) -> str:
    scope = '"windowStartMillis"' + (', "agentId"' if mode == "PER_AGENT" else "")
    return f"""WITH {FIRED}, found AS (
  SELECT "eventTimeMillis" // 300000 * 300000 AS "windowStartMillis", "agentId", "sessionId", "requestId", "userId", "eventTimeMillis", seq, confidence,
    trim("evidenceSnippet", ' \t\n\r') AS said FROM fired
  WHERE "guardrailName" = 'PROMPT_INJECTION' AND trim("evidenceSnippet") <> ''
), told AS (SELECT DISTINCT said, said AS text FROM found
), {_vectors("said", "told")}, projected AS (
  SELECT said, b, round(sum(x * ((s * s % 2147483647) % 2001 - 1000)), 4) >= 0 AS up FROM (
    SELECT said, b, x, (b * 384 + pos + 1) * 48271 % 2147483647 AS s FROM vectors, range(48) r(b)) GROUP BY said, b
), cells AS (SELECT said, b // 8 AS tab, sum(CASE WHEN up THEN 1 << (b % 8) ELSE 0 END) AS cell FROM projected GROUP BY 1, 2
), texts AS (
  SELECT {scope}, said, count(DISTINCT "sessionId") AS sessions, min("eventTimeMillis") AS born, arg_min(seq, ("eventTimeMillis", seq)) AS seq,
    arg_min("requestId", ("eventTimeMillis", seq)) AS request FROM found GROUP BY ALL
), weighed AS (
  SELECT {scope}, tab, cell, sum(sessions) AS weight, arg_min(seq, (-sessions, born, seq)) AS seed_seq, arg_min(born, (-sessions, born, seq)) AS born
  FROM texts JOIN cells USING (said) GROUP BY ALL
), named AS (SELECT {scope}, seed_seq, max(weight) AS weight, min(born) AS born FROM weighed GROUP BY {scope}, seed_seq
), seeds AS (
  SELECT n.*, t.said AS seed_text, t.request AS seed_request FROM (
    SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY weight DESC, born, seed_seq) - 1 AS seed FROM named) n
  JOIN (SELECT *, seq AS seed_seq FROM texts) t USING ({scope}, seed_seq) WHERE seed < 3
), near AS (
  SELECT {scope}, seed, said, round(sum(v.x * u.x), 6) AS similarity FROM texts JOIN seeds s USING ({scope})
  JOIN vectors v USING (said) JOIN vectors u ON u.said = s.seed_text AND u.pos = v.pos GROUP BY {scope}, seed, said HAVING round(sum(v.x * u.x), 6) >= 0.88
), members AS (SELECT f.*, n.seed, n.similarity FROM found f JOIN near n USING ({scope}, said)
), sizes AS (
  SELECT {scope}, seed, count(DISTINCT "sessionId") AS sessions, count(DISTINCT "requestId") AS size, count(DISTINCT "agentId") AS agents,
    count(*) AS findings, min("eventTimeMillis") AS first_at, max("eventTimeMillis") AS last_at FROM members GROUP BY {scope}, seed
), best AS (
  SELECT * FROM sizes WHERE sessions >= 3 QUALIFY row_number() OVER (PARTITION BY {scope} ORDER BY sessions DESC, size DESC, seed) = 1
), incidents AS (
  SELECT 'PROMPT_INJECTION_CAMPAIGN' AS "incidentType", '{mode}' AS "detectionMode", {scope}, "windowStartMillis" + 300000 AS "windowEndMillis",
    size AS "groupSize", sessions AS "uniqueSessionCount", agents, findings,
    CASE WHEN size >= 12 THEN 'CRITICAL' WHEN size >= 8 THEN 'HIGH' WHEN size >= 5 THEN 'MEDIUM' WHEN size >= 3 THEN 'LOW' END AS severity,
    first_at AS "firstEventTimeMillis", last_at AS "lastEventTimeMillis", seed_request AS "representativeRequestId", seed_text AS "representativeRequest",
    size || ' similar prompt injections from ' || sessions || ' sessions' AS explanation, CAST(seed AS INTEGER) AS seed
  FROM best JOIN seeds USING ({scope}, seed)
)"""


for _entry, _mode in (("campaign_windows_global", "GLOBAL"), ("campaign_windows_per_agent", "PER_AGENT")):
    ORACLES[_entry] = f"{_campaign_windows(_mode)} SELECT * FROM incidents"
ORACLES["campaign_members"] = f"""{_campaign_windows("GLOBAL")}
SELECT "windowStartMillis", "agentId", "sessionId", "requestId", "userId", "eventTimeMillis", seq, confidence, similarity
FROM members JOIN best USING ("windowStartMillis", seed)"""

_CENTROIDS = """parts AS (
  SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings
), means AS (SELECT label, pos, avg(x) AS m FROM parts GROUP BY 1, 2
), centroids AS (
  SELECT label, list(m / n ORDER BY pos) AS centroid
  FROM (SELECT *, sqrt(sum(m * m) OVER (PARTITION BY label)) AS n FROM means) GROUP BY label)"""
ORACLES["cosine_similarity"] = f"""WITH {_CENTROIDS}
SELECT vec_id, label,
  round(list_cosine_similarity(embedding::DOUBLE[], centroid), 6) AS similarity
FROM embeddings JOIN centroids USING (label)"""
ORACLES["nearest_centroid"] = f"""WITH {_CENTROIDS}, scored AS (
  SELECT e.vec_id, e.label, c.label AS nearest_label,
    list_cosine_similarity(e.embedding::DOUBLE[], c.centroid) AS s
  FROM embeddings e, centroids c
)
SELECT vec_id, label, nearest_label, round(s, 6) AS similarity FROM scored
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, nearest_label) = 1"""

# --- reports ------------------------------------------------------------------------------

AGG_1M = f"{ROUTED}, {_agg('(60000)')}"
ORACLES["report_totals_1m"] = f"""WITH {AGG_1M}
SELECT "windowStartMillis", count(*) AS aggregates, CAST(sum("triggeredCount") AS BIGINT) AS triggered,
  CAST(sum("detectorErrorCount") AS BIGINT) AS "detectorErrors", CAST(sum("totalEvents") AS BIGINT) AS events
FROM agg GROUP BY 1"""
ORACLES["report_by_guardrail"] = f"""WITH {AGG_1M}
SELECT "windowStartMillis", "guardrailName" AS guardrail, CAST(sum("triggeredCount") AS BIGINT) AS triggered,
  CAST(sum("totalEvents") AS BIGINT) AS events, CAST(sum("detectorErrorCount") AS BIGINT) AS "detectorErrors"
FROM agg GROUP BY 1, 2"""
ORACLES["report_triggered_share"] = f"""WITH {AGG_1M}
SELECT "windowStartMillis", "guardrailName" AS guardrail,
  round(sum("triggeredCount") / greatest(sum("totalEvents"), 1)::DOUBLE, 12) AS "triggeredShare"
FROM agg GROUP BY 1, 2"""
ORACLES["report_tokens"] = f"""WITH {AGG_1M}
SELECT "windowStartMillis", "guardrailName" AS guardrail, CAST(sum("inputTokens") AS BIGINT) AS "inputTokens",
  CAST(sum("outputTokens") AS BIGINT) AS "outputTokens" FROM agg GROUP BY 1, 2"""


def _last(source: str, columns: dict[str, str], where: str = "true", rounded: bool = False) -> str:
    value = lambda c: f'round(max("{c}"), 12)' if rounded else f'max("{c}")'
    outs = ", ".join(f'{value(c)} AS "{out}"' for out, c in columns.items())
    return f"""SELECT "guardrailName" AS guardrail, "windowName", "windowStartMillis", {outs}
FROM {source} a WHERE {where} AND "windowStartMillis" = (
  SELECT max("windowStartMillis") FROM {source} b
  WHERE b."guardrailName" = a."guardrailName" AND b."windowName" = a."windowName")
GROUP BY 1, 2, 3"""


ORACLES["report_last_percentiles"] = f"WITH {AGG} " + _last("agg", {
    "p50": "p50Confidence", "p95": "p95Confidence",
    "triggeredP50": "triggeredP50Confidence", "triggeredP95": "triggeredP95Confidence",
}, "\"guardrailName\" IN ('PROMPT_INJECTION', 'TOXICITY')")
ORACLES["report_quality_totals"] = f"""WITH {QUALITY}
SELECT "windowStartMillis", count(*) AS rows, round(max("detectorErrorRate"), 12) AS "maxDetectorErrorRate",
  round(max("missingConfidenceRate"), 12) AS "maxMissingConfidenceRate",
  max("maxDetectorLatencyMs") AS "maxDetectorLatencyMs"
FROM quality WHERE "windowName" = '1m' GROUP BY 1"""
ORACLES["report_quality_by_guardrail"] = f"""WITH {QUALITY}, last AS ({_last("quality", {
    c: c for c in (
        "detectorErrorRate", "triggerRate", "confidenceCoverageRate", "avgDetectorLatencyMs",
        "maxDetectorLatencyMs")
})})
SELECT * REPLACE (round("detectorErrorRate", 12) AS "detectorErrorRate", round("triggerRate", 12) AS "triggerRate",
  round("confidenceCoverageRate", 12) AS "confidenceCoverageRate",
  round("avgDetectorLatencyMs", 12) AS "avgDetectorLatencyMs") FROM last"""
ORACLES["report_emit_latency"] = f"WITH {QUALITY} " + _last(
    "quality", {"latestEventToEmitMs": "e2eLatestEventToEmitMs", "windowEndToEmitMs": "e2eWindowEndToEmitMs"}
)
ORACLES["report_incident_latency"] = f"""{_R} {INCIDENTS}
SELECT "ruleName", greatest(0, {EMITTED_AT_MS} - "lastEventTimeMillis") AS "lastEventToEmitMs" FROM incidents
QUALIFY row_number() OVER (
  PARTITION BY "ruleName" ORDER BY "emittedAtEventTimeMillis" DESC, "incidentId" DESC) = 1"""
ORACLES["report_emissions"] = f"""WITH {AGG} SELECT "windowName", count(*) AS emitted FROM agg GROUP BY 1"""
ORACLES["report_intake"] = f"""WITH {ROUTED}
SELECT (SELECT count(*) FROM norm WHERE reason_code IS NULL) AS "validEvents",
  (SELECT count(*) FROM norm WHERE reason_code IS NOT NULL) AS "invalidEvents",
  (SELECT count(*) FROM routed WHERE late) AS "lateEvents",
  (SELECT count(*) FROM ev) AS "onTimeEvents\""""
ORACLES["report_incidents_by_rule"] = f"""{_R} {UPDATES}
SELECT "emittedAtEventTimeMillis" // 300000 * 300000 AS "windowStartMillis", "ruleName",
  count(*) AS incidents, count(*) FILTER (WHERE "emissionRevision" > 1) AS updates
FROM incidents GROUP BY 1, 2"""
ORACLES["report_incidents_by_severity"] = f"""{_R} {INCIDENTS}
SELECT "ruleName", severity, count(*) AS incidents FROM incidents GROUP BY 1, 2"""
ORACLES["replay_summary"] = f"""WITH {ROUTED}, rows AS (SELECT * FROM norm WHERE reason_code IS DISTINCT FROM 'PARSE_ERROR')
SELECT count(*) FILTER (WHERE "eventType" = 'AGENT_REQUEST') AS requests,
  count(*) FILTER (WHERE "eventType" = 'AGENT_RESPONSE') AS responses,
  count(*) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING') AS findings,
  count(*) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING' AND triggered) AS "triggeredFindings",
  (SELECT count(*) FROM norm WHERE reason_code IS NOT NULL) AS invalid,
  count(*) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING' AND "detectorStatus" = 'ERROR') AS "detectorErrors",
  count(*) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING' AND "guardrailName" = 'PROMPT_INJECTION'
    AND "evidenceSnippet" IS NOT NULL) AS "evidenceBearingInjections",
  (SELECT count(*) FROM routed WHERE late) AS late
FROM rows"""
ORACLES["runtime_contract"] = f"""WITH {ROUTED}
SELECT "eventType", count(*) AS "passedEvents", max("eventTimeMillis") AS "latestEventTimeMillis",
  'tumbling-event-time' AS "windowType", '1m,5m' AS "aggregateWindows",
  'AT_LEAST_ONCE' AS "deliveryGuarantee", CAST(30 AS BIGINT) AS "outOfOrdernessSeconds",
  CAST(300 AS BIGINT) AS "lateToleranceSeconds", CAST(60 AS BIGINT) AS "idleTimeoutSeconds",
  CAST(30 AS BIGINT) AS "checkpointIntervalSeconds", CAST(5 AS BIGINT) AS "watermarkIntervalSeconds"
FROM ev GROUP BY 1"""
ORACLES["run_verdict"] = """WITH runs AS (
  SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS generator_exit_code,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey % 3 AS INTEGER) END AS failed_checkpoints,
    CAST(floor(o_totalprice) AS BIGINT) % 130 AS backpressure_ms_per_second,
    o_custkey % 4 * 100 AS lag_at_end, o_orderkey % 3 * 100 AS lag_after_settle,
    (o_orderkey + o_custkey) % 3 * 50 AS lag_after_recovery FROM orders)
SELECT *, CASE WHEN generator_exit_code <> 0 THEN 'failed'
  WHEN coalesce(failed_checkpoints, 0) > 0 OR backpressure_ms_per_second >= 100 THEN 'degraded'
  WHEN lag_after_recovery > 0 AND lag_after_recovery < lag_after_settle THEN 'still-draining'
  WHEN lag_after_recovery > 0 THEN 'not-recovering'
  WHEN lag_at_end + lag_after_settle > 0 THEN 'recovered' ELSE 'stable' END AS verdict FROM runs"""

# --- specified correlations and reviews ---------------------------------------------------

ORACLES["findings_around_requests"] = f"""WITH {ROUTED}
SELECT r."agentId", r."sessionId", r."requestId", r."eventTimeMillis", count(f.seq) AS findings,
  count(f.seq) FILTER (WHERE f.triggered) AS "triggeredFindings"
FROM ev r LEFT JOIN ev f ON f."eventType" = 'GUARDRAIL_FINDING' AND f."agentId" = r."agentId"
  AND f."sessionId" = r."sessionId"
  AND f."eventTimeMillis" BETWEEN r."eventTimeMillis" - 2000 AND r."eventTimeMillis" + 30000
WHERE r."eventType" = 'AGENT_REQUEST' GROUP BY 1, 2, 3, 4"""
ORACLES["request_findings"] = f"""WITH {ROUTED}
SELECT r."agentId", r."sessionId", r."requestId", r.seq AS "requestSeq", r."eventTimeMillis" AS "requestMillis",
  f.seq AS "findingSeq", f."eventTimeMillis" AS "findingMillis", f."guardrailName", f.triggered
FROM ev r JOIN ev f ON f."eventType" = 'GUARDRAIL_FINDING' AND f."agentId" = r."agentId" AND f."sessionId" = r."sessionId"
  AND f."eventTimeMillis" BETWEEN r."eventTimeMillis" - 2000 AND r."eventTimeMillis" + 30000
WHERE r."eventType" = 'AGENT_REQUEST'"""
ORACLES["request_correlation"] = f"""WITH {ROUTED}, grouped AS (
  SELECT "agentId", "sessionId", "requestId",
    count(*) FILTER (WHERE "eventType" = 'AGENT_REQUEST') AS requests,
    count(*) FILTER (WHERE "eventType" = 'AGENT_RESPONSE') AS responses,
    count(*) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING') AS findings,
    count(DISTINCT "guardrailName") FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING' AND triggered)
      AS "firedGuardrails",
    max(confidence) FILTER (WHERE "eventType" = 'GUARDRAIL_FINDING') AS "maxConfidence",
    min("eventTimeMillis") AS "firstEventTimeMillis", max("eventTimeMillis") AS "lastEventTimeMillis"
  FROM ev GROUP BY 1, 2, 3)
SELECT *, "firedGuardrails" >= 2 AS "multiSignal" FROM grouped"""
ORACLES["enriched_findings"] = f"""WITH {ROUTED}
SELECT seq, "agentId", "guardrailName", n_name AS owner, r_name AS criticality
FROM ev LEFT JOIN nation ON "agentId" = 'agent-' || n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE "eventType" = 'GUARDRAIL_FINDING'"""
# Here every sequence is formed and the latest start is taken.
ORACLES["escalations"] = f"""WITH {ROUTED}, e AS (
  SELECT *, "eventTimeMillis" AS t,
    triggered AND "guardrailName" = 'PROMPT_INJECTION' AND confidence >= 0.5 AS injection,
    triggered AND "guardrailName" = 'SYSTEM_PROMPT_LEAKAGE' AS leak FROM ev
), pairs AS (
  SELECT b."agentId", b."sessionId", b.t, b.seq, a.t AS start FROM e a JOIN e b
    ON a.injection AND b.injection AND a."agentId" = b."agentId" AND a."sessionId" = b."sessionId"
    AND (a.t, a.seq) < (b.t, b.seq) AND b.t - a.t <= 600000
), leaks AS (
  SELECT l."agentId", l."sessionId", l.t, l.seq, max(p.start) AS start FROM pairs p JOIN e l
    ON l.leak AND p."agentId" = l."agentId" AND p."sessionId" = l."sessionId"
    AND (p.t, p.seq) < (l.t, l.seq) AND l.t - p.start <= 600000 GROUP BY 1, 2, 3, 4
)
SELECT h."agentId", h."sessionId", h."requestId", max(l.start) AS "startMillis", h.t AS "eventTimeMillis",
  h."outputTokens"
FROM leaks l JOIN e h ON h."outputTokens" >= 350 AND l."agentId" = h."agentId" AND l."sessionId" = h."sessionId"
  AND (l.t, l.seq) < (h.t, h.seq) AND h.t - l.start <= 600000
GROUP BY h."agentId", h."sessionId", h."requestId", h."outputTokens", h.t"""
ORACLES["rising_injections"] = f"""WITH {ROUTED}, pi AS (
  SELECT *, lag(confidence, 1) OVER w AS c1, lag(confidence, 2) OVER w AS c2, lag("eventTimeMillis", 2) OVER w AS t2 FROM ev
  WHERE triggered AND "guardrailName" = 'PROMPT_INJECTION' AND confidence IS NOT NULL
  WINDOW w AS (PARTITION BY "agentId", "sessionId" ORDER BY "eventTimeMillis", seq)
)
SELECT "agentId", "sessionId", "requestId", t2 AS "startMillis", "eventTimeMillis", c2 AS "firstConfidence", confidence AS "lastConfidence"
FROM pi WHERE confidence > c1 AND c1 > c2 AND "eventTimeMillis" - t2 <= 600000"""
ORACLES["runaway_agents"] = f"""WITH {ROUTED}, answers AS (
  SELECT *, lag("outputTokens", 1) OVER w AS o1, lag("outputTokens", 2) OVER w AS o2, lag("eventTimeMillis", 2) OVER w AS t2, lag(seq, 2) OVER w AS seq2
  FROM ev WHERE "eventType" = 'AGENT_RESPONSE' WINDOW w AS (PARTITION BY "agentId", "sessionId" ORDER BY "eventTimeMillis", seq)
)
SELECT a."agentId", a."sessionId", a."requestId", max(l."eventTimeMillis") AS "startMillis", a."eventTimeMillis",
  a.o2 AS "firstOutputTokens", a."outputTokens" AS "lastOutputTokens"
FROM answers a JOIN ev l ON l."agentId" = a."agentId" AND l."sessionId" = a."sessionId" AND l."eventType" = 'GUARDRAIL_FINDING' AND l.triggered
  AND l."guardrailName" = 'LOOPING' AND (l."eventTimeMillis", l.seq) < (a.t2, a.seq2) AND a."eventTimeMillis" - l."eventTimeMillis" <= 600000
WHERE a."outputTokens" > a.o1 AND a.o1 > a.o2
GROUP BY a."agentId", a."sessionId", a."requestId", a."eventTimeMillis", a.o2, a."outputTokens", a.seq"""
ORACLES["finding_severity"] = f"""WITH {ROUTED}
SELECT seq, "guardrailName", CASE
  WHEN "guardrailName" = 'PROMPT_INJECTION' THEN
    CASE WHEN confidence >= 0.9 THEN 'CRITICAL' WHEN confidence >= 0.75 THEN 'HIGH'
         WHEN confidence >= 0.55 THEN 'MEDIUM' ELSE 'LOW' END
  WHEN "guardrailName" = 'TOXICITY' THEN
    CASE WHEN confidence >= 0.9 THEN 'HIGH' WHEN confidence >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END
  WHEN "guardrailName" = 'LOOPING' AND triggered THEN 'MEDIUM'
  WHEN "guardrailName" = 'SYSTEM_PROMPT_LEAKAGE' AND triggered THEN 'CRITICAL' ELSE 'LOW' END AS severity
FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING'"""
ORACLES["affected_sessions"] = f"""WITH {ROUTED}
SELECT "agentId", "eventTimeMillis" // 300000 * 300000 AS "windowStartMillis",
  count(DISTINCT "sessionId") FILTER (WHERE triggered) AS "affectedSessions"
FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING' GROUP BY 1, 2"""
ORACLES["slice_rollup"] = f"""WITH {ROUTED}
SELECT "tenantId", "agentId", "modelName", "sessionId", count(*) AS findings,
  count(*) FILTER (WHERE triggered) AS triggered, CAST(sum("outputTokens") AS BIGINT) AS "outputTokens"
FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING' GROUP BY ROLLUP ("tenantId", "agentId", "modelName", "sessionId")"""
ORACLES["slice_windows"] = f"""WITH {ROUTED}, sliced AS (
  SELECT "eventTimeMillis" // 300000 * 300000 AS "windowStartMillis", triggered, "outputTokens", unnest([
    {{'dimension': 'sessionId', 'value': "sessionId"}}, {{'dimension': 'modelName', 'value': "modelName"}},
    {{'dimension': 'channel', 'value': channel}}, {{'dimension': 'tenantId', 'value': "tenantId"}}]) AS s
  FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING')
SELECT "windowStartMillis", s.dimension AS dimension, s.value AS value, count(*) AS findings,
  count(*) FILTER (WHERE triggered) AS triggered, CAST(sum("outputTokens") AS BIGINT) AS "outputTokens"
FROM sliced GROUP BY 1, 2, 3"""
ORACLES["latency_by_version"] = f"""WITH {ROUTED}
SELECT "guardrailName", "guardrailVersion", count(*) AS findings,
  quantile_disc("detectorLatencyMs", 0.95) AS "latencyMs", max("detectorLatencyMs") AS "maxLatencyMs"
FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING' GROUP BY 1, 2"""
ORACLES["version_drift"] = f"""WITH {ROUTED}, rates AS (
  SELECT "guardrailName", "guardrailVersion" || '.' || "partition" AS "guardrailVersion", count(*) AS findings,
    avg(confidence) AS "avgConfidence", avg(CASE WHEN triggered THEN 1.0 ELSE 0.0 END::DOUBLE) AS "triggerRate"
  FROM ev WHERE "eventType" = 'GUARDRAIL_FINDING' GROUP BY 1, 2
)
SELECT "guardrailName", "guardrailVersion", findings, round("avgConfidence", 12) AS "avgConfidence",
  round("triggerRate", 12) AS "triggerRate",
  round("avgConfidence" - lag("avgConfidence") OVER w, 12) AS "avgConfidenceDrift",
  round("triggerRate" - lag("triggerRate") OVER w, 12) AS "triggerRateDrift"
FROM rates WINDOW w AS (PARTITION BY "guardrailName" ORDER BY "guardrailVersion")"""
ORACLES["incidents_by_version"] = f"""{_R} {INCIDENTS}
SELECT "agentId", "ruleName", v AS "guardrailVersion", count(*) AS incidents
FROM (SELECT *, unnest(string_split("guardrailVersions", ',')) AS v FROM incidents) GROUP BY 1, 2, 3"""
ORACLES["incident_members"] = f"""WITH {STATE}, spelled AS (
  SELECT "agentId", "sessionId", epoch, n_all, unnest(['requestId', 'guardrailName', 'guardrailVersion', 'policyVersion']) AS kind,
    unnest(["requestId", "guardrailName", "guardrailVersion", "policyVersion"]) AS value FROM state
), named AS (
  SELECT "agentId", "sessionId", epoch, kind, value, min(n_all) AS "firstFinding" FROM spelled WHERE trim(value) <> '' GROUP BY ALL
)
SELECT *, row_number() OVER (PARTITION BY "agentId", "sessionId", epoch, kind ORDER BY "firstFinding") AS rank FROM named"""
ORACLES["incidents_by_session_version"] = f"""{_R} {INCIDENTS}
SELECT "agentId", "sessionId", "ruleName", v AS "guardrailVersion", count(*) AS incidents
FROM (SELECT *, unnest(string_split("guardrailVersions", ',')) AS v FROM incidents) GROUP BY 1, 2, 3, 4"""
ORACLES["incidents_per_session"] = f"""{_R} {UPDATES}
SELECT "agentId", "sessionId", count(*) AS incidents, count(DISTINCT "ruleName") AS rules,
  count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE severity = 'HIGH') AS high,
  count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, min("emittedAtEventTimeMillis") AS "firstIncidentMillis",
  max("emittedAtEventTimeMillis") AS "lastIncidentMillis" FROM incidents GROUP BY 1, 2"""
ORACLES["suppressed_incidents"] = f"""{_R} {UPDATES}, lagged AS (
  SELECT *, coalesce("emittedAtEventTimeMillis" - lag("emittedAtEventTimeMillis") OVER (
      PARTITION BY "agentId", "sessionId", "ruleName" ORDER BY "emittedAtEventTimeMillis", "emissionRevision",
      "firstEventTimeMillis") <= 180000, false) AS duplicate
  FROM incidents
), kept AS (
  SELECT *, sum(CASE WHEN duplicate THEN 0 ELSE 1 END) OVER (
      PARTITION BY "agentId", "sessionId", "firstEventTimeMillis"
      ORDER BY "emittedAtEventTimeMillis", "ruleName", "emissionRevision" ROWS UNBOUNDED PRECEDING) AS n
  FROM lagged
)
SELECT "incidentId", "ruleName", "emissionRevision", "emittedAtEventTimeMillis", duplicate,
  NOT duplicate AND n > 3 AS "overLimit" FROM kept"""
ORACLES["audit_sample"] = f"""WITH {ROUTED}
SELECT seq, "requestId", 0.1::DOUBLE AS "inclusionProbability" FROM ev
WHERE CAST('0x' || md5("requestId")[1:8] AS BIGINT) % 1000 < 100"""
ORACLES["detector_quality"] = f"""WITH {ROUTED}, judged AS (
  SELECT triggered AS d, toxic = 1 AS l, CASE WHEN quality = 1 THEN 2.0 ELSE 4.0 END::DOUBLE AS w
  FROM ev JOIN labels ON seq = doc_id WHERE "eventType" = 'GUARDRAIL_FINDING' AND "guardrailName" = 'TOXICITY'
), cells AS (
  SELECT count(*) AS judged, coalesce(sum(w) FILTER (WHERE d AND l), 0) AS tp,
    coalesce(sum(w) FILTER (WHERE d AND NOT l), 0) AS fp, coalesce(sum(w) FILTER (WHERE NOT d AND l), 0) AS fn,
    coalesce(sum(w) FILTER (WHERE NOT d AND NOT l), 0) AS tn FROM judged
)
SELECT 'TOXICITY' AS "guardrailName", *,
  CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 12) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 12) ELSE 0 END AS recall,
  CASE WHEN fp + tn > 0 THEN round(fp / (fp + tn), 12) ELSE 0 END AS "falsePositiveRate",
  round((fp + fn) / (tp + fp + fn + tn), 12) AS "disagreementRate" FROM cells"""

# A finished stream has the result of the batch.
ORACLES["stream_intake"] = ORACLES["on_time_events"]
ORACLES["stream_affected_sessions"] = ORACLES["affected_sessions"]
ORACLES["stream_quality"] = ORACLES["guardrail_quality"]
ORACLES["stream_request_findings"] = ORACLES["request_findings"]
ORACLES["stream_incident_messages"] = f"""{_R} {INCIDENTS}
SELECT "incidentId", "ruleName", severity, "appliedPolicyVersion", CAST("lastEventTimeMillis" AS VARCHAR) AS "lastEventTimeMillis", summary
FROM incidents"""
ORACLES["stream_guardrail_agg"] = ORACLES["guardrail_agg_all"]
ORACLES["stream_session_incidents"] = ORACLES["session_incidents"]
