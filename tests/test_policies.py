import random

import pytest
from pyspark.sql import functions as F

from railwatch.operators import policies as P
from railwatch.settings import Settings

SECTIONS = {
    "promptInjection": {"medium": 0.55, "high": 0.75, "critical": 0.90}, "toxicity": {"high": 0.90},
    "looping": {"severity": "MEDIUM"}, "systemPromptLeakage": {"severity": "CRITICAL"},
}
TEXT = """version: "policy-v1"
updatedBy: "ops"
updatedAt: "2026-08-26T00:00:00Z"
defaults:
  promptInjection: {medium: 0.55, high: 0.75, critical: 0.90}
  toxicity:
    medium: 0.70
    high: 0.90
  looping:
    severity: medium
  systemPromptLeakage:
    severity: "CRITICAL"
suppression:
  duplicateWindowSeconds: 180
agents:
  agent-7:
    promptInjection:
      high: 0.72
"""


def parsed(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    return [r.policy for r in P.parse_policies(frame).orderBy("seq").collect()]


def test_messages(spark):
    good, escaped, *bad = parsed(
        spark, TEXT, TEXT.replace("\n", "\\n"), TEXT.replace("  toxicity:\n    medium: 0.70\n    high: 0.90\n", ""),
        "defaults: [", "", None, "just text", TEXT.replace("severity: medium", "severity: loud"),
        TEXT.replace("high: 0.72", "high: much"),
    )
    assert good == escaped
    assert (good.version, good.updatedAt) == ("policy-v1", "2026-08-26T00:00:00Z")
    assert good.defaults.promptInjection.critical == 0.90 and good.defaults.looping.severity == "MEDIUM"
    assert good.defaults.toxicity.critical is None
    assert good.agents["agent-7"].promptInjection.high == 0.72 and good.agents["agent-7"].toxicity is None
    assert bad == [None] * len(bad)


def test_bootstrap_file(spark, tmp_path):
    path = tmp_path / "policy.yaml"
    path.write_text(TEXT)
    row, = P.load_policy(spark, str(path)).collect()
    assert (row.seq, row.policy.version) == (-1, "policy-v1")
    assert P.load_policy(spark, str(tmp_path / "none.yaml"), required=False).count() == 0
    with pytest.raises(FileNotFoundError):
        P.load_policy(spark, str(tmp_path / "none.yaml"))


def timeline(spark, *entries):
    frame = None
    for seq, (version, at) in enumerate(entries):
        one = P.policy_literal(spark, version, at, SECTIONS, seq=seq)
        frame = one if frame is None else frame.unionByName(one)
    return frame


@pytest.mark.parametrize("entries,accepted", [
    ([("v1", "2026-01-02T00:00:00Z"), ("v2", "2026-01-03T00:00:00Z")], [True, True]),
    ([("v1", "2026-01-02T00:00:00Z"), ("v2", "2026-01-01T00:00:00Z")], [True, False]),
    ([("v1", "2026-01-02T00:00:00Z"), ("v0", None)], [True, True]),
    ([("v2", None), ("v1", None)], [True, False]),
    ([("v2", "not a time"), ("v1", "")], [True, False]),
])
def test_decisions(spark, entries, accepted):
    rows = P.decide(timeline(spark, *entries)).orderBy("seq").collect()
    assert [r.accepted for r in rows] == accepted
    loose = P.decide(timeline(spark, *entries), Settings(reject_older_policies=False)).collect()
    assert all(r.accepted for r in loose)


def test_decisions_equal_a_sequential_loop(spark):
    rng = random.Random(11)
    version = lambda: None if rng.random() < 0.15 else f"v{rng.randrange(30):02d}"
    at = lambda: None if rng.random() < 0.4 else f"2026-01-{rng.randrange(1, 29):02d}T00:00:00Z"
    rows = [(seq * 700_000, version(), at()) for seq in range(120)]
    empty = P.policy_literal(spark, "v", None, SECTIONS).first().policy
    frame = spark.createDataFrame(
        [(s, {**empty.asDict(recursive=True), "version": v, "updatedAt": a}) for s, v, a in rows], P.PARSED
    )
    current, expected = None, {}
    for seq, v, a in rows:
        keep = True
        if current is not None:
            cv, ca = current
            if ca is not None and a is not None:
                keep = a >= ca
            elif ca is None and a is None and v is not None and cv is not None:
                keep = v >= cv
        expected[seq] = keep
        if keep:
            current = (v, a)
    got = {r.seq: r.accepted for r in P.decide(frame).collect()}
    assert got == expected and not all(expected.values())


def test_override_field_by_field(spark):
    policy = P.policy_literal(spark, "v1", None, SECTIONS, {"a": {"promptInjection": {"high": 0.72}}})
    rows = {r.agentId: r for r in P.effective_policies(policy).collect()}
    assert (rows["a"].promptInjection_high, rows["a"].promptInjection_critical) == (0.72, 0.90)
    assert (rows["*"].promptInjection_high, rows["*"].looping_severity) == (0.75, "MEDIUM")


def test_as_of_join(spark):
    policies = timeline(spark, ("v0", None), ("v1", None), ("v2", None)).withColumn("seq", F.col("seq") * 100_000 + 10)
    rows = spark.createDataFrame([(s, "a") for s in (0, 10, 11, 100_009, 100_010, 900_000)], "seq long, agentId string")
    attached = P.attach_policy(rows, policies)
    limits = P.thresholds(F.col("policy"), F.col("agentId"))
    got = {r.seq: (r.v, r.h) for r in attached.select("seq", limits["appliedPolicyVersion"].alias("v"), limits["piHigh"].alias("h")).collect()}
    assert got == {
        0: ("config-fallback", 0.90), 10: ("v0", 0.75), 11: ("v0", 0.75), 100_009: ("v0", 0.75),
        100_010: ("v1", 0.75), 900_000: ("v2", 0.75),
    }


def test_as_of_join_over_logs_whose_offsets_overlap(spark):
    """Policies and rows of several partitions: only the common order says what was in force."""
    rng = random.Random(8)
    messages, rows = [], []
    for k in range(60):
        at, partition = rng.randrange(400_000), rng.randrange(2)
        messages.append((at, "policies", partition, k // 2, f"v{k:03d}"))
        for source in ("findings", "requests"):
            rows.append((at + rng.choice([-1, 0, 0, 1, 70_000]), source, partition, k // 3, f"{source}-{k}"))
    rows.append((min(m[0] for m in messages) - 1, "findings", 0, 0, "early"))
    text = lambda v: f'version: "{v}"\ndefaults:\n' + "".join(f"  {n}:\n    severity: HIGH\n" for n in ("promptInjection", "toxicity", "looping", "systemPromptLeakage"))
    log = spark.createDataFrame([(text(v), s, p, o, at) for at, s, p, o, v in messages], "value string, source string, partition int, seq long, ingestMillis long")
    timeline = P.accepted_timeline(None, P.on_time_line(P.parse_policies(log.repartition(3))))
    current, ruled = None, []
    for at, source, partition, offset, version in sorted(messages):
        if current is None or version >= current:
            current = version
            ruled.append(((at, source, partition, offset), version))
    frame = spark.createDataFrame([(i, at, s, p, o) for at, s, p, o, i in rows], "id string, ingestMillis long, source string, partition int, seq long")
    got = {r.id: r.version for r in P.attach_policy(frame, timeline, P.TIME_LINE).select("id", "policy.version").collect()}
    assert got == {i: next((v for place, v in reversed(ruled) if place <= (at, s, p, o)), None) for at, s, p, o, i in rows}
    assert None in got.values() and len(set(got.values())) > 3


def test_messages_keep_their_timestamp(spark):
    from railwatch.sources.streams import from_messages

    log = spark.sql("SELECT cast('x' AS binary) AS value, 't' AS topic, 3 AS partition, 9L AS offset, timestamp'2026-01-01 00:00:00.123' AS timestamp")
    assert tuple(from_messages(log).first()) == ("x", "t", 3, 9, 1_767_225_600_123)
