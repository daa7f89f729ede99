import random

import pytest

from railwatch.operators import correlation as C
from tests.rows import BASE, events, finding


def response(seq, t, tokens, **other):
    return finding(seq, t, None, triggered=None, eventType="AGENT_RESPONSE", outputTokens=tokens, **other)


def made(n, seed, span):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        session, t = f"s{rng.randrange(4)}", rng.randrange(span)
        kind = rng.randrange(4)
        if kind == 0:
            rows.append(finding(seq, t, confidence=rng.choice([None, .2, .5, .8, .9, .95]), triggered=rng.random() < .8, sessionId=session))
        elif kind == 1:
            rows.append(finding(seq, t, "LOOPING", triggered=rng.random() < .7, sessionId=session))
        elif kind == 2:
            rows.append(response(seq, t, rng.choice([None, 10, 50, 300, 450]), sessionId=session))
        else:
            rows.append(finding(seq, t, "SYSTEM_PROMPT_LEAKAGE", sessionId=session, outputTokens=rng.choice([5, 500])))
    return rows


def sessions(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["eventTimeMillis"], r["seq"])):
        out.setdefault(r["sessionId"], []).append(r)
    return out.values()


def rising(rows, steps, within):
    out = []
    for some in sessions(rows):
        pi = [r for r in some if r["triggered"] and r["guardrailName"] == "PROMPT_INJECTION" and r["confidence"] is not None]
        for k in range(steps - 1, len(pi)):
            part = pi[k - steps + 1:k + 1]
            if all(a["confidence"] < b["confidence"] for a, b in zip(part, part[1:], strict=False)) and part[-1]["eventTimeMillis"] - part[0]["eventTimeMillis"] <= within:
                out.append((part[-1]["requestId"], part[0]["eventTimeMillis"], part[0]["confidence"], part[-1]["confidence"]))
    return sorted(out)


def runaway(rows, steps, within):
    out = []
    for some in sessions(rows):
        loops = [k for k, r in enumerate(some) if r["triggered"] and r["guardrailName"] == "LOOPING"]
        answers = [k for k, r in enumerate(some) if r["eventType"] == "AGENT_RESPONSE" and r["outputTokens"] is not None]
        for k in range(steps, len(answers)):
            part = answers[k - steps:k + 1]
            tokens = [some[i]["outputTokens"] for i in part]
            start = max((some[i]["eventTimeMillis"] for i in loops if i < part[0]), default=None)
            if start is not None and tokens == sorted(set(tokens)) and some[part[-1]]["eventTimeMillis"] - start <= within:
                out.append((some[part[-1]]["requestId"], start, tokens[0], tokens[-1]))
    return sorted(out)


def escalated(rows, confidence, tokens, within):
    out = []
    for some in sessions(rows):
        hit = [r["triggered"] and r["guardrailName"] == "PROMPT_INJECTION" and (r["confidence"] or 0) >= confidence for r in some]
        leak = [bool(r["triggered"]) and r["guardrailName"] == "SYSTEM_PROMPT_LEAKAGE" for r in some]
        for d, last in enumerate(some):
            if (last["outputTokens"] or 0) < tokens:
                continue
            starts = [some[a]["eventTimeMillis"] for c in range(d) if leak[c] for b in range(c) if hit[b] for a in range(b) if hit[a]]
            if starts and last["eventTimeMillis"] - max(starts) <= within:
                out.append((last["requestId"], max(starts), last["eventTimeMillis"], last["outputTokens"]))
    return sorted(out)


@pytest.mark.parametrize("span,within", [(60_000, 9_000), (3_000_000, 180_000), (3_000_000, 700_000)])
def test_patterns_equal_plain_loops(spark, span, within):
    rows = made(240, span, span)
    table = events(spark, rows).repartition(3)
    got = lambda df: sorted(tuple(r)[2:] for r in df.collect())
    drop_time = lambda found: sorted((r, s, a, b) for r, s, _, a, b in found)
    for steps in (2, 3):
        want = rising(rows, steps, within)
        assert drop_time(got(C.rising_injections(table, steps, within))) == want
        assert steps == 3 or want
    for steps in (1, 2):
        want = runaway(rows, steps, within)
        assert drop_time(got(C.runaway_agents(table, steps, within))) == want
        assert steps == 2 or want
    assert got(C.escalations(table, 0.5, 300, within)) == escalated(rows, 0.5, 300, within)


def test_rows_of_one_instant_go_by_sequence(spark):
    rows = [finding(k, 0, confidence=c) for k, c in enumerate((0.2, 0.3, 0.4))]
    assert [r.requestId for r in C.rising_injections(events(spark, rows)).collect()] == ["req-2"]
    assert C.rising_injections(events(spark, rows[::-1])).first().startMillis == BASE
    assert C.runaway_agents(events(spark, [])).collect() == []
    for bad in (lambda: C.rising_injections(events(spark, []), 1), lambda: C.runaway_agents(events(spark, []), 0)):
        with pytest.raises(ValueError):
            bad()
