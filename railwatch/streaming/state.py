"""State of the session stream.

The states are a table, one row a session, that each micro-batch reads and writes anew (:func:`continue_sessions`): a session
costs its rows and not a call per key between Python and the JVM.  :class:`SessionProcessor` is the same rules for Spark's keyed
state.  Rows are used in order of ``(event time, seq)``.  Time in the rules is event time: a row ends the session before it
when it lies beyond that one's deadline.  No watermark filters rows, so every row that was routed on
time is used however far its partition lags.  Wall-clock time matters only where
a query runs on and on, and only frees the state of keys that have been silent for long.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from railwatch.schemas import (
    BURST_RULE, LEAK_RULE, LEAKAGE, LOOP_RULE, LOOPING, MIXED_RULE, PROMPT_INJECTION, TOXIC_RULE,
    TOXICITY,
)
from railwatch.settings import Settings

_COUNTED = {PROMPT_INJECTION: "pi", TOXICITY: "tox", LOOPING: "loop", LEAKAGE: "leak"}
_LISTED = {
    "requestIds": "requestId", "guardrailNames": "guardrailName",
    "guardrailVersions": "guardrailVersion", "policyVersions": "policyVersion",
}


def _ordered(frames: Iterator[pd.DataFrame], time: str) -> Iterator[dict]:
    parts = list(frames)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    columns = [rows[c].tolist() for c in rows.columns]
    for i in np.lexsort((rows["seq"].to_numpy(), rows[time].to_numpy())):
        yield {c: values[i] for c, values in zip(rows.columns, columns)}


class Recent:
    """Evidence of the look-back rule per millisecond, in time order.

    Rows in order cost the same however much is in the look-back: the count is carried along, and of the confidences those
    that a later one exceeds are left out of ``tops``.
    """

    def __init__(self, seen: dict):
        self.entries = deque(sorted([int(at), count, top] for at, (count, top) in seen.items()))
        self.count = sum(e[1] for e in self.entries)
        self._rank()

    def _rank(self) -> None:
        self.tops: deque[tuple[int, float]] = deque()
        for at, _, top in self.entries:
            self._raise(at, top)

    def _raise(self, at: int, top: float) -> None:
        while self.tops and self.tops[-1][1] <= top:
            self.tops.pop()
        self.tops.append((at, top))

    def add(self, at: int, top: float) -> None:
        self.count += 1
        if not self.entries or at > self.entries[-1][0]:
            self.entries.append([at, 1, top])
            self._raise(at, top)
            return
        place = len(self.entries) - 1 if at == self.entries[-1][0] else bisect_left(self.entries, at, key=lambda e: e[0])
        if self.entries[place][0] != at:
            self.entries.insert(place, [at, 0, top])
        entry = self.entries[place]
        entry[1:] = entry[1] + 1, max(entry[2], top)
        if at == self.entries[-1][0]:
            self._raise(at, entry[2])
        else:
            self._rank()

    def expire(self, oldest: int) -> None:
        while self.entries and self.entries[0][0] < oldest:
            self.count -= self.entries.popleft()[1]
        while self.tops and self.tops[0][0] < oldest:
            self.tops.popleft()

    def between(self, low: int, high: int) -> tuple[int, float]:
        """Their number and greatest confidence, -1 where there is none."""
        if not self.entries:
            return 0, -1.0
        if self.entries[0][0] >= low and self.entries[-1][0] <= high:
            return self.count, self.tops[0][1]
        found = [e for e in self.entries if low <= e[0] <= high]
        return sum(e[1] for e in found), max((e[2] for e in found), default=-1.0)

    def saved(self) -> dict:
        return {str(at): (count, top) for at, count, top in self.entries}


def _restart_timer(handle: StatefulProcessorHandle, timerValues, after_ms: int | None) -> None:
    if after_ms is None:
        return
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + after_ms)


class SessionRules:
    """Session rules; they give out the rows that :func:`incidents.incident_rows` turns into incidents."""

    _L, _S, _D = T.LongType(), T.StringType(), T.DoubleType()
    OUTPUT = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("agentId", "sessionId", "tenantId", "ruleName")]
        + [T.StructField("revision", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in (
            "t", "seq", "first_t", "last_t", "n_all", "n_pi", "n_tox", "n_loop", "n_leak")]
        + [T.StructField(n, T.DoubleType()) for n in ("max_pi", "max_tox")]
        + [T.StructField(n, T.LongType()) for n in ("win_pi", "win_tox")]
        + [T.StructField(n, T.DoubleType()) for n in ("winmax_pi", "winmax_tox")]
        + [T.StructField(n, T.ArrayType(T.StringType())) for n in _LISTED]
    )

    def __init__(self, settings: Settings):
        self.settings = settings

    def _fresh(self) -> dict:
        return {
            "first": None, "last": 0, "all": 0, "n": dict.fromkeys(_COUNTED.values(), 0),
            "max": {"pi": -1.0, "tox": -1.0}, "seen": {"pi": Recent({}), "tox": Recent({})},
            "revisions": {}, "lists": {k: {} for k in _LISTED}, "deadline": None,
        }

    @staticmethod
    def _loaded(body: str) -> dict:
        state = json.loads(body)
        state["seen"] = {kind: Recent(seen) for kind, seen in state["seen"].items()}
        state["lists"] = {k: dict.fromkeys(values) for k, values in state["lists"].items()}
        return state

    @staticmethod
    def _saved(state: dict) -> str:
        seen = {kind: recent.saved() for kind, recent in state["seen"].items()}
        return json.dumps({**state, "seen": seen, "lists": {k: list(values) for k, values in state["lists"].items()}})

    def step(self, state: dict, key, row: dict) -> tuple[dict, list[dict]]:
        """The state after the next row of a session, and what the rules give out at it."""
        if state["deadline"] is not None and row["t"] > state["deadline"]:
            state = self._fresh()
        self._record(state, row)
        return state, self._emissions(state, key, row)

    def _record(self, state: dict, row: dict) -> None:
        t, confidence = int(row["t"]), row["confidence"]
        confidence = None if confidence is None or confidence != confidence else float(confidence)
        state["first"] = t if state["first"] is None else state["first"]
        state["last"] = max(state["last"], t)
        state["deadline"] = state["last"] + self.settings.session_timeout_ms
        state["all"] += 1
        for out, column in _LISTED.items():
            value, known = row[column], state["lists"][out]
            limit = self.settings.max_request_ids if out == "requestIds" else None
            if isinstance(value, str) and value.strip() and value not in known and (limit is None or len(known) < limit):
                known[value] = None
        kind = _COUNTED.get(row["guardrailName"])
        if kind is None:
            return
        state["n"][kind] += 1
        if kind not in state["max"]:
            return
        if confidence is not None:
            state["max"][kind] = max(state["max"][kind], confidence)
        # Evidence of the look-back rule per millisecond: at most one entry per millisecond
        # of the window, however many findings there are.
        minimum = {
            "pi": self.settings.pi_and_toxic_min_injection_confidence,
            "tox": self.settings.pi_and_toxic_min_toxicity_confidence,
        }[kind]
        if minimum is None or (confidence is not None and confidence >= minimum):
            state["seen"][kind].add(t, -1.0 if confidence is None else max(confidence, -1.0))
        for seen in state["seen"].values():
            seen.expire(state["last"] - self.settings.pi_and_toxic_window_ms)

    def _emissions(self, state: dict, key, row: dict) -> list[dict]:
        s, n, name, t = self.settings, state["n"], row["guardrailName"], int(row["t"])
        within = lambda: {k: seen.between(t - s.pi_and_toxic_window_ms, t) for k, seen in state["seen"].items()}
        rules = []
        if name == PROMPT_INJECTION and n["pi"] >= s.injection_burst_min:
            rules.append(BURST_RULE)
        if name == TOXICITY and n["tox"] >= s.toxicity_campaign_min:
            rules.append(TOXIC_RULE)
        if name in (PROMPT_INJECTION, LEAKAGE) and n["pi"] and n["leak"]:
            rules.append(LEAK_RULE)
        if name == LOOPING and n["loop"] >= s.looping_min:
            rules.append(LOOP_RULE)
        if s.pi_and_toxic_enabled and name in (PROMPT_INJECTION, TOXICITY) and (s.emit_updates or MIXED_RULE not in state["revisions"]):
            win = within()
            if win["pi"][0] >= s.pi_and_toxic_min_injections and win["tox"][0] >= s.pi_and_toxic_min_toxic:
                rules.append(MIXED_RULE)
        out = []
        for rule in rules:
            revision = state["revisions"].get(rule, 0) + 1
            if revision > 1 and not s.emit_updates:
                continue
            state["revisions"][rule] = revision
            win = within()
            out.append({
                "agentId": key[0], "sessionId": key[1], "tenantId": row["tenantId"], "ruleName": rule,
                "revision": revision, "t": t, "seq": None if row["seq"] is None else int(row["seq"]), "first_t": state["first"],
                "last_t": state["last"], "n_all": state["all"],
                **{f"n_{k}": v for k, v in n.items()},
                "max_pi": state["max"]["pi"], "max_tox": state["max"]["tox"],
                "win_pi": win["pi"][0], "win_tox": win["tox"][0],
                "winmax_pi": win["pi"][1], "winmax_tox": win["tox"][1],
                **{k: list(v) for k, v in state["lists"].items()},
            })
        return out


class SessionProcessor(StatefulProcessor, SessionRules):
    """The rules for Spark's keyed state: the rows of a key may come in several frames of a micro-batch, in no order."""

    def __init__(self, settings: Settings, idle_ms: int | None = None):
        SessionRules.__init__(self, settings)
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "body string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.state.get()
        state = self._fresh() if known is None else self._loaded(known[0])
        out: list[dict] = []
        for row in _ordered(rows, "t"):
            state, emitted = self.step(state, key, row)
            out += emitted
        _restart_timer(self.handle, timerValues, self.idle_ms)
        self.state.update((self._saved(state),))
        if out:
            yield pd.DataFrame(out, columns=self.OUTPUT.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


SESSION = ["agentId", "sessionId"]
FOUND = ("tenantId", "requestId", "t", "seq", "guardrailName", "guardrailVersion", "policyVersion", "confidence")
STATE = T.StructType([
    T.StructField("agentId", T.StringType()), T.StructField("sessionId", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("updatedMillis", T.LongType()),
])
# Rows of kind ``emitted`` have the columns of the rules, those of kind ``state`` have those of ``STATE``.
CONTINUED = T.StructType([T.StructField("kind", T.StringType()), *SessionRules.OUTPUT.fields, *STATE.fields[2:]])
HELD = 1 << 18  # characters of states and entries of lists that a scan holds before it gives rows out


def continue_sessions(found: DataFrame, known: DataFrame, at_ms: int, settings: Settings) -> DataFrame:
    """The session rules over the findings of one micro-batch (``SESSION`` and ``FOUND``) on top of the states of earlier ones.

    Rows of a session come sorted out of Spark's exchange behind the row of its state, and are read in Arrow batches; a state
    without new rows is handed on as it is.
    """
    rules, schema = SessionRules(settings), to_arrow_schema(CONTINUED)
    columns = [*SESSION, "body", "updatedMillis", *FOUND]
    ordered = (
        found.unionByName(known, allowMissingColumns=True).repartition(*SESSION)
        .sortWithinPartitions(*SESSION, F.col("body").isNull(), "t", F.col("seq").asc_nulls_last()).select(*columns)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, body, updated, out, held = None, None, None, None, [], 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in schema], schema=schema)

        def saved() -> dict:
            text, at = (body, updated) if state is None else (rules._saved(state), at_ms)
            return {"kind": "state", "agentId": key[0], "sessionId": key[1], "body": text, "updatedMillis": at}

        for batch in batches:
            for agent, session, text, at, *values in zip(*[batch.column(c).to_pylist() for c in columns]):
                if held >= HELD:
                    yield given()
                    out, held = [], 0
                if (agent, session) != key:
                    if key is not None:
                        out.append(saved())
                        held += len(out[-1]["body"])
                    key, state, body, updated = (agent, session), None, None, None
                if text is not None:
                    body, updated = text, at
                    continue
                if state is None:
                    state = rules._fresh() if body is None else rules._loaded(body)
                state, emitted = rules.step(state, key, dict(zip(FOUND, values)))
                for row in emitted:
                    out.append({"kind": "emitted", **row})
                    held += 64 + sum(len(row[c]) for c in _LISTED)
        if key is not None:
            out.append(saved())
            yield given()

    return ordered.mapInArrow(scan, CONTINUED)
