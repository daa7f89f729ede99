"""Conversation repair against all edit sequences."""

import hashlib
import re
import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from railwatch.llm.queries import QUERIES
from railwatch.llm.repair import damaged, repair_summary, repaired

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(SPACE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "none")
        seen.add((role, text))
    return out


def summary(rows):
    """Of ``turn, role, text`` in order: every sequence of edits is tried."""
    faults = faults_of(rows)
    inserts = [c for n in range(3) for c in product(("user", "assistant"), repeat=n)]
    partial = {("", ""): (0, [])}  # audit and initials so far
    for k, (_, role, text) in enumerate(rows + [(None, None, None)]):
        grown = {}
        for (audit, initials), (cost, lines) in partial.items():
            for put in inserts:
                letters, start = initials + "".join(p[0] for p in put), cost + 2 * len(put)
                begun, head = lines + [f"{p}:" for p in put], audit + "I" * len(put)
                if k == len(rows):
                    steps = [("", letters, 0, [])]
                else:
                    cut = faults[k] == "truncated"
                    steps = [("D", letters, 3, [])]
                    if faults[k] not in ("blank", "duplicate"):
                        steps.append(("K", letters + (role[:1] or "?"), cut, [f"{role}:{text}"]))
                        steps += [("R", letters + r[0], 2 + cut, [f"{r}:{text}"]) for r in ("user", "assistant")]
                for letter, ending, more, line in steps:
                    if re.match(r"(s?(ua)*u?)?\Z", ending):
                        at = (head + letter, ending)
                        if at not in grown or grown[at][0] > start + more:
                            grown[at] = (start + more, begun + line)
        # Longer ways of one state only matter while they are not dearer than the cheapest by all that repairs can cost.
        low = min(v[0] for v in grown.values())
        partial = {a: v for a, v in grown.items() if v[0] <= low + 8}
    cost, audit, lines = min((c, audit, lines) for (audit, initials), (c, lines) in partial.items() if LEGAL.match(initials))
    turns = [t for t, _, _ in rows if t is not None]
    firsts = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False)), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def made(n, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for conv in range(n):
        for _ in range(rng.integers(1, 6)):
            turn = None if rng.random() < 0.1 else int(rng.integers(0, 9))
            role = str(rng.choice(["user", "assistant", "system", "tool", ""], p=[0.4, 0.3, 0.1, 0.1, 0.1]))
            out.append((conv, turn, role, str(rng.choice(["Yes.", "no", " ", "", "What?\n", "Oh! ok", "Fine!\t"]))))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_equal_to_all_edits(spark):
    rows = made(220)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in repair_summary(table).collect()}
    for conv in range(220):
        own = ordered([r[1:] for r in rows if r[0] == conv])
        assert got[conv] == summary(own), own


def test_repaired_rows_are_the_summary_in_full(spark):
    rows = made(60, 9)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r.conv_id: r for r in repair_summary(table).collect()}
    by = {}
    for r in repaired(table).collect():
        by.setdefault(r.conv_id, []).append(r)
    for conv, some in by.items():
        some.sort(key=lambda r: r.position)
        assert [r.position for r in some] == list(range(len(some)))
        assert "".join(r.edit for r in some) == want[conv].audit
        kept = [r for r in some if r.edit != "D"]
        assert LEGAL.match("".join(r.role[0] for r in kept))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == want[conv].repaired_sha256
    assert set(by) == {c for c, r in want.items() if r.audit}


def test_state_crosses_arrow_batches(spark):
    """One conversation of many batches, with a system message at its start."""
    rows = [(1, 0, "system", "Be kind.")] + [(1, k, "user" if k % 2 else "assistant", f"text {k}.") for k in range(1, 30_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = repair_summary(table).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # The last message is a user's: an answer put in is cheaper than taking it out.
    assert len(got) == 1 and (got[0].cost, got[0].audit) == (2, "K" * 30_000 + "I")
    lines = [f"{r}:{t}" for _, _, r, t in rows] + ["assistant:"]
    assert got[0].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_planted_faults_and_odd_rows(spark):
    rows = [(c, t, ["user", "assistant", "system", None][t % 4] if t is not None else "user", ["Hi. There!", None, "", "word"][c % 4]) for c in [*range(40), None] for t in [0, 1, 2, None] for c in [c if c is not None else 0]]
    rows += [(None, 3, "user", "Odd."), (None, None, None, None), (2**60 + 1, 2**60, "user", "Big."), (2**60 + 1, 2**60, "user", "Big.")]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, edits int")
    want = {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        own = want.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {r[0]: tuple(r)[1:] for r in repair_summary(damaged(table), F.col("present")).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: summary(ordered(own)) if len(own) else nothing for c, own in want.items() if len(own) < 7} | {c: got[c] for c, own in want.items() if len(own) >= 7}
    assert repair_summary(table.where("false")).collect() == [] and repaired(table.where("false")).collect() == []


def test_query_has_its_columns(spark):
    got = QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id").distinct().count()
