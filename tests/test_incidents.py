import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from railwatch.operators import incidents as I
from railwatch.operators.policies import policy_literal
from railwatch.settings import Settings
from tests.rows import BASE, events, finding
from tests.test_policies import SECTIONS

PI, TOX, LOOP, LEAK = "PROMPT_INJECTION", "TOXICITY", "LOOPING", "SYSTEM_PROMPT_LEAKAGE"
ONCE, EVERY = Settings(), Settings(emit_updates=True)


def run(spark, rows, settings=ONCE, timeline=None):
    found = I.session_incidents(events(spark, rows), timeline, settings).collect()
    return sorted(found, key=lambda r: (r.emittedAtEventTimeMillis, r.ruleName))


def policy(spark, **agents):
    return policy_literal(spark, "policy-v1", "2026-08-26T00:00:00Z", SECTIONS, {
        a.replace("_", "-"): part for a, part in agents.items()
    })


HALF_HOUR = 1_800_000


def scenarios():
    """Many sessions for one run: name -> findings of that session."""
    override = {"agentId": "agent-2"}
    return {
        "burst": [finding(i, i * 1000, PI, c) for i, c in enumerate((0.6, 0.7, 0.76, 0.99))],
        "plain": [finding(i, i, PI, 0.73) for i in range(3)],
        "override": [finding(i, i, PI, 0.73, **override) for i in range(3)],
        "toxic": [finding(i, i, TOX) for i in range(3)],
        "leak-last": [finding(1, 0, PI, 0.91), finding(2, 1, LEAK), finding(3, 2, LEAK)],
        "leak-first": [finding(1, 0, LEAK), finding(2, 1, PI, 0.5), finding(3, 2, PI, 0.99)],
        "loop": [finding(i, i, LOOP) for i in range(5)],
        "near": [finding(1, 123, TOX, 0.6), finding(2, 60_123, PI, 0.8)],
        "edge": [finding(1, 123, TOX, 0.6), finding(2, 300_123, PI, 0.8)],
        "far": [finding(1, 123, TOX, 0.6), finding(2, 300_124, PI, 0.8)],
        "weak": [finding(1, 0, TOX, None), finding(2, 1, PI, 0.8), finding(3, 2, TOX, 0.7)],
        "same": [finding(1, 0, LOOP), finding(2, HALF_HOUR, LOOP)],
        "apart": [finding(1, 0, LOOP), finding(2, HALF_HOUR + 1, LOOP)],
        "quiet": [finding(i, i, PI, 0.99, triggered=bool(i % 2) or None) for i in range(4)],
    }


def by_session(spark, settings, timeline=None):
    rows, found = [], defaultdict(list)
    for number, (name, part) in enumerate(scenarios().items()):
        rows += [{**r, "sessionId": name, "seq": r["seq"] + 100 * number} for r in part]
    for row in run(spark, rows, settings, timeline):
        found[row.sessionId].append(row)
    return found


@pytest.fixture(scope="module")
def once(spark):
    return by_session(spark, ONCE, policy(spark, agent_2={"promptInjection": {"high": 0.72}}))


def test_burst(once):
    row, = once["burst"]
    assert (row.ruleName, row.severity, row.triggeredFindingsCount) == ("PROMPT_INJECTION_BURST", "HIGH", 3)
    assert row.incidentId == f"agent-1|burst|PROMPT_INJECTION_BURST|{BASE}"
    assert row.requestIds == ["req-0", "req-1", "req-2"]
    assert (row.guardrailNames, row.guardrailVersions, row.policyVersions) == ([PI], ["pi-v1"], ["policy-v1"])
    assert (row.appliedPolicyVersion, row.emissionRevision) == ("policy-v1", 1)
    assert row.summary == "Prompt injection burst detected: findings=3, maxConfidence=0.760"


def test_severity_follows_the_policy_of_the_agent(once):
    assert [r.severity for r in once["plain"]] == ["MEDIUM"]
    assert [r.severity for r in once["override"]] == ["HIGH"]


def test_rules_without_confidence_and_without_triggers(once):
    row, = once["toxic"]
    assert (row.severity, row.summary) == ("MEDIUM", "Toxicity campaign detected: findings=3, maxConfidence=n/a")
    assert once["quiet"] == []


def test_leakage_with_injection_either_order(once):
    first, = once["leak-last"]
    second, = once["leak-first"]
    assert (first.severity, first.emittedAtEventTimeMillis) == ("CRITICAL", BASE + 1)
    assert (second.severity, second.emittedAtEventTimeMillis) == ("HIGH", BASE + 1)


def test_injection_and_toxicity_look_back(once):
    assert [r.ruleName for r in once["near"] + once["edge"]] == ["PI_AND_TOXIC"] * 2 and once["far"] == []
    assert once["near"][0].severity == "HIGH"
    assert once["near"][0].summary == (
        "PI_AND_TOXIC detected: promptInjectionFindings=1, toxicityFindings=1, "
        "maxPromptInjectionConfidence=0.800, maxToxicityConfidence=0.600"
    )
    assert [r.emittedAtEventTimeMillis - BASE for r in once["weak"]] == [1]


def test_inactivity_starts_a_new_epoch(spark, once):
    assert len(once["same"]) == 1 and once["apart"] == []
    apart = events(spark, scenarios()["apart"])
    epochs = I.session_epochs(apart).orderBy("epoch").collect()
    assert [(e.epoch, e.triggeredFindingsCount) for e in epochs] == [(0, 1), (1, 1)]
    open_now = I.open_sessions(apart, F.lit(BASE + HALF_HOUR).cast("long")).collect()
    assert [e.epoch for e in open_now] == [1]


def test_updates_and_fallback_thresholds(spark):
    found = by_session(spark, EVERY)
    assert [(r.severity, r.emissionRevision) for r in found["loop"]] == [
        ("MEDIUM", 1), ("MEDIUM", 2), ("HIGH", 3), ("HIGH", 4)
    ]
    assert [(r.severity, r.emissionRevision) for r in found["burst"]] == [("MEDIUM", 1), ("HIGH", 2)]
    assert found["burst"][0].appliedPolicyVersion == "config-fallback"


def test_look_back_settings(spark):
    strict = by_session(spark, Settings(pi_and_toxic_min_toxicity_confidence=0.65))
    assert [r.emittedAtEventTimeMillis - BASE for r in strict["weak"]] == [2] and strict["near"] == []
    off = emitted_rules(spark, Settings(pi_and_toxic_enabled=False))
    assert "PI_AND_TOXIC" not in off and len(off) == 4


def emitted_rules(spark, settings):
    rows = [r for i, part in enumerate(scenarios().values()) for r in (
        {**x, "sessionId": str(i), "seq": x["seq"] + 100 * i} for x in part)]
    state = I.session_state(events(spark, rows), settings)
    return {r.ruleName for r in I.emissions(state, settings).select("ruleName").distinct().collect()}


def test_request_ids_stop_at_the_cap_and_blanks_are_skipped(spark):
    rows = [finding(i, i, LOOP if i < 60 else PI, 0.1, requestId=f"r{i // 2}" if i else " ") for i in range(130)]
    settings = Settings(injection_burst_min=70, max_request_ids=50)
    burst = [r for r in run(spark, rows, settings) if r.ruleName == "PROMPT_INJECTION_BURST"][0]
    assert burst.requestIds == [f"r{i}" for i in range(50)]
    assert burst.guardrailNames == [LOOP, PI]


def test_block_width_is_guarded():
    with pytest.raises(ValueError):
        Settings(pi_and_toxic_window_ms=2, session_timeout_ms=1)


def simulate(rows, settings):
    """Plain sequential evaluation in canonical order."""
    sessions, out = defaultdict(list), []
    for r in rows:
        sessions[r["agentId"], r["sessionId"]].append(r)
    for key, group in sessions.items():
        history, first, last, revisions = [], None, None, {}
        for r in sorted(group, key=lambda r: (r["eventTimeMillis"], r["seq"])):
            t = r["eventTimeMillis"]
            if last is not None and t - last > settings.session_timeout_ms:
                history, first, revisions = [], None, {}
            first, last = t if first is None else first, t
            history.append(r)
            n = {g: sum(h["guardrailName"] == g for h in history) for g in (PI, TOX, LOOP, LEAK)}
            near = [h["guardrailName"] for h in history if h["eventTimeMillis"] >= t - settings.pi_and_toxic_window_ms]
            g = r["guardrailName"]
            rules = []
            if g == PI and n[PI] >= 3:
                rules.append("PROMPT_INJECTION_BURST")
            if g == TOX and n[TOX] >= 3:
                rules.append("TOXICITY_CAMPAIGN")
            if g in (PI, LEAK) and n[PI] and n[LEAK]:
                rules.append("LEAKAGE_WITH_INJECTION")
            if g == LOOP and n[LOOP] >= 2:
                rules.append("LOOPING_PERSISTENCE")
            if g in (PI, TOX) and near.count(PI) and near.count(TOX):
                rules.append("PI_AND_TOXIC")
            for rule in rules:
                revisions[rule] = revisions.get(rule, 0) + 1
                if revisions[rule] == 1 or settings.emit_updates:
                    ids = list(dict.fromkeys(h["requestId"] for h in history))[: settings.max_request_ids]
                    out.append((*key, rule, first, t, len(history), revisions[rule], tuple(ids)))
    return sorted(out)


@pytest.mark.parametrize("settings", [ONCE, EVERY])
def test_random_sessions_equal_a_sequential_loop(spark, settings):
    rng = random.Random(21)
    rows = []
    for i in range(500):
        # Coarse times give many ties; one session holds a third of the rows.
        session = "busy" if rng.random() < 0.33 else f"s{rng.randrange(12)}"
        t = rng.randrange(0, 14_400_000, 60_000 if rng.random() < 0.7 else 1)
        rows.append(finding(i, t, rng.choice([PI, PI, TOX, TOX, LOOP, LEAK, "OTHER"]), round(rng.random(), 3),
                            sessionId=session, requestId=f"r{rng.randrange(120)}"))
    got = sorted(
        (r.agentId, r.sessionId, r.ruleName, r.firstEventTimeMillis, r.emittedAtEventTimeMillis,
         r.triggeredFindingsCount, r.emissionRevision, tuple(r.requestIds))
        for r in run(spark, rows, settings)
    )
    assert got == simulate(rows, settings)


def test_members_as_rows_say_what_the_lists_say(spark):
    from railwatch.operators import incidents as I
    from railwatch.settings import Settings
    from tests.rows import events, finding

    rows = [finding(i, i * 1_000, confidence=0.9, requestId=f"r{i % 7}", policyVersion=f"p{i // 9}", sessionId=f"s{i % 2}") for i in range(40)]
    rows += [finding(90, 7_200_000, confidence=0.9, requestId="r1", sessionId="s0")] * 1
    table, settings = events(spark, rows), Settings(emit_updates=True)
    state = I.session_state(table, settings)
    members = {}
    for r in sorted(I.incident_members(state).collect(), key=lambda r: r["rank"]):
        members.setdefault((r.sessionId, r.epoch, r.kind), []).append((r.firstFinding, r.value))
        assert r["rank"] == len(members[r.sessionId, r.epoch, r.kind])
    found = I.session_incidents(table, None, settings).collect()
    assert len(found) > 20
    for r in found:
        listed = [v for at, v in members[r.sessionId, 0, "requestId"] if at <= r.triggeredFindingsCount]
        assert r.requestIds == listed
        assert r.policyVersions == [v for at, v in members[r.sessionId, 0, "policyVersion"] if at <= r.triggeredFindingsCount]
    bare = I.session_incidents(table, None, Settings(emit_updates=True, list_members=False)).collect()
    assert {(r.incidentId, r.emissionRevision, r.summary) for r in bare} == {(r.incidentId, r.emissionRevision, r.summary) for r in found}
    assert all(r.requestIds == [] for r in bare)
