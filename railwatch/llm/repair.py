"""Conversation repair: the cheapest edits that turn a conversation into well-formed turns.

Well formed is an optional system message and then pairs of a user's and an assistant's message, or
nothing.  Rows are dealt by conversation once and sorted by turn inside the partitions.  A first stream reads each
conversation from its end and carries, across Arrow batches, what the rest costs from each of four
states; the edit to take in each state is one byte a row (two bits a state).  Spark's own sorter turns the stream round, spilling
rows and their bytes where a conversation is large, and a second stream follows the edits from the
first row on.  Neither stream holds more than a batch and four numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.sources.staging import ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: nothing yet, after the system message, after a user's, after an assistant's message.
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_GROWN = (2, 2, 3, 2)  # the state after the one message that may be put in, or given another role
_NAMES = (None, None, "user", "assistant")
_AT_END = (0, 2 * INSERT, INSERT, 0)
_LETTERS = "DIKR"  # in ASCII order, so the smaller number wins a tie
_SPACE = r" \t\n\u000B\f\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` with faults planted by the CRC of ``conv_id:turn`` modulo 20.

    0 takes the row away (it stays with ``present`` false), 1 empties its text, 2 removes full stops, question
    and exclamation marks, 3 repeats it, 4 makes its role ``user``.  Nulls read as one space.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("_kind"))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_kind") != 0).alias("present"),
    )


def _faulty(rows: DataFrame, present: Column) -> DataFrame:
    """Rows of one layout with their first fault, dealt by conversation."""
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce(present, F.lit(False)).alias("present"),
    ).repartition("conv_id")
    trimmed = F.expr(f"trim(BOTH '{_SPACE}' FROM text)")
    # The exchange by conversation serves this window too.
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.asc_nulls_first("turn"))) > 1
    return rows.withColumns({"_trimmed": trimmed, "again": seen}).withColumn("fault", F.when(~F.col("present"), "absent").when(
        F.col("_trimmed") == "", "blank").when(F.col("again"), "duplicate").when(
        ~F.right("_trimmed", F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("none")).drop("_trimmed")


def _costs_to_go(initial: str, fault: str, after: tuple) -> tuple[tuple, int]:
    """What this row and the rest cost from each state, and the edit of each state in two bits."""
    lasting = fault not in ("blank", "duplicate")
    extra = TRUNCATED if fault == "truncated" else 0
    to = _NEXT.get(initial, (None,) * 4)
    best = []
    for state in range(4):
        options = [(DELETE + after[state], 0)]
        if lasting:
            if to[state] is not None:
                options.append((KEEP + extra + after[to[state]], 2))
            options.append((REROLE + extra + after[_GROWN[state]], 3))
        best.append(min(options))
    user, assistant = best[2], best[3]
    best[2], best[3] = min(user, (INSERT + assistant[0], 1)), min(assistant, (INSERT + user[0], 1))
    for state in (0, 1):
        best[state] = min(best[state], (INSERT + best[2][0], 1))
    return tuple(b[0] for b in best), sum(b[1] << 2 * state for state, b in enumerate(best))


def _decided(rows: DataFrame, present: Column) -> DataFrame:
    """Rows with ``edits`` (two bits a state) and ``back``, their number from the end, in order inside each partition."""
    faulty = _faulty(rows, present)
    # Numbers go to Python as text, where a null does not turn them into floats.
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("conv_id", "turn", "role", "text", "fault")],
        T.StructField("edits", T.IntegerType()), T.StructField("back", T.LongType()),
    ])

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, costs, back = object(), _AT_END, 0
        for frame in frames:
            edits, numbers = [], []
            for conv, initial, fault in zip(frame["conv_id"], frame["role"].str[:1], frame["fault"], strict=True):
                if conv != current:
                    current, costs, back = conv, _AT_END, 0
                edit = 0
                if fault != "absent":
                    costs, edit = _costs_to_go(initial, fault, costs)
                edits.append(edit)
                numbers.append(back)
                back += 1
            yield frame.assign(edits=edits, back=numbers)

    ordered = faulty.sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("again")).select(
        F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "fault")
    return ordered.mapInPandas(decide, schema).sortWithinPartitions("conv_id", F.desc("back"))


def _edits(state: int, packed: int) -> Iterator[tuple[str, str | None, int]]:
    """The edits up to and with the row's own: letter, role it gives, state after."""
    while True:
        edit = packed >> 2 * state & 3
        if edit == 1:
            state = _GROWN[state]
            yield "I", _NAMES[state], state
            continue
        if edit == 3:
            state = _GROWN[state]
            yield "R", _NAMES[state], state
        else:
            yield _LETTERS[edit], None, state
        return


def _ending(state: int) -> Iterator[tuple[str, int]]:
    while state in (1, 2):
        state = _GROWN[state]
        yield _NAMES[state], state


def repaired(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, position, edit, turn, role, text, fault``: each conversation with its edits, as rows.

    ``edit`` is K (kept), R (given another role), D (taken out) or I (put in, without a turn); without the
    rows of D the roles of a conversation begin with ``(s?(ua)+)?``.  Rows are ``conv_id, turn, role, text`` in order of
    turn, nulls first; those of one turn in order of role and text.  Blank and repeated messages must go.  Among the cheapest edits
    the first in ASCII order is taken.  Rows where ``present`` is not true have no part in it.

    Null ids are one conversation of their own; null roles and texts read as one space; empty texts are blank; a message
    with an empty role cannot be kept under it.  Other columns are not carried.  An empty table gives an empty result.
    """
    decided = _decided(rows, F.lit(True) if present is None else present)
    ship_package(rows.sparkSession)
    schema = T.StructType([
        T.StructField("conv_id", T.StringType()), T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("turn", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("fault", T.StringType()),
    ])

    def rebuild(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, position = object(), 0, 0
        for frame in frames:
            out = []

            def put(conv, *rest):
                nonlocal position
                out.append((conv, position, *rest))
                position += 1

            for conv, turn, role, text, fault, packed, back in zip(
                frame["conv_id"], frame["turn"], frame["role"], frame["text"], frame["fault"], frame["edits"], frame["back"], strict=True,
            ):
                if conv != current:
                    current, state, position = conv, 0, 0
                if fault != "absent":
                    for letter, given, state in _edits(state, packed):
                        if letter == "I":
                            put(conv, "I", None, given, "", None)
                        else:
                            put(conv, letter, turn, given or role, text, fault)
                            if letter == "K":
                                state = _NEXT[role[:1]][state]
                if back == 0:
                    for given, state in _ending(state):
                        put(conv, "I", None, given, "", None)
            yield pd.DataFrame(out, columns=schema.names, dtype=object)

    return _typed(decided.mapInPandas(rebuild, schema), rows, "conv_id", "turn")


def repair_summary(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row a conversation: faults, cost and edits of its repair (see :func:`repaired`).

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.  ``gaps`` are turns that no row has between the
    smallest and the largest, nulls aside; ``illegal`` neighbours are those whose initials are not
    su, ua or au; ``audit`` has one letter an edit; the hash is of the repaired lines ``role:text``, joined by line feeds.
    A conversation without present rows has zeros, no audit and the hash of nothing.  ``audit`` is the only
    value that grows with a conversation; nulls and the rest as in :func:`repaired`.
    """
    decided = _decided(rows, F.lit(True) if present is None else present)
    ship_package(rows.sparkSession)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([
        T.StructField("conv_id", T.StringType()), *[T.StructField(c, T.LongType()) for c in counts],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def sum_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, tally = object(), None
        for frame in frames:
            done = []
            for conv, turn, role, text, fault, packed, back in zip(
                frame["conv_id"], frame["turn"], frame["role"], frame["text"], frame["fault"], frame["edits"], frame["back"], strict=True,
            ):
                if conv != current:
                    current, tally = conv, _Tally()
                if fault != "absent":
                    tally.take(None if turn is None else int(turn), role, text, fault, packed)
                if back == 0:
                    done.append((conv, *tally.end()))
            yield pd.DataFrame(done, columns=schema.names, dtype=object)

    return _typed(decided.mapInPandas(sum_up, schema), rows, "conv_id")


def _typed(found: DataFrame, rows: DataFrame, *names: str) -> DataFrame:
    return found.withColumns({c: F.col(c).cast(rows.schema[c].dataType) for c in names})


class _Tally:
    """Counts of one conversation while its rows pass in order."""

    def __init__(self) -> None:
        self.state, self.before, self.low, self.turn, self.distinct = 0, None, None, None, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def take(self, turn: int | None, role: str, text: str, fault: str, packed: int) -> None:
        self.faults[fault] += 1
        if turn is not None and turn != self.turn:
            self.low, self.turn, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        for letter, given, state in _edits(self.state, packed):
            self.audit.append(letter)
            self.state = _NEXT[initial][state] if letter == "K" else state
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
            if letter in "KR" and fault == "truncated":
                self.cost += TRUNCATED
            if letter != "D":
                self._line(given or role, "" if letter == "I" else text)

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def end(self) -> tuple:
        for given, self.state in _ending(self.state):
            self.audit.append("I")
            self.cost += INSERT
            self._line(given, "")
        gaps = self.turn - self.low + 1 - self.distinct if self.distinct else 0
        return (gaps, *(self.faults[f] for f in ("blank", "duplicate", "truncated")), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
