"""Versioned threshold policies: parse, accept or reject, resolve per agent, attach."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.functions import instant_millis
from railwatch.operators.scan import running
from railwatch.schemas import POLICY, POLICY_SECTIONS, TIME_LINE
from railwatch.settings import DEFAULTS, Settings

# Thresholds in force before any policy exists, and for absent thresholds.
FALLBACK_VERSION = "config-fallback"
DEFAULT_PI_HIGH = 0.90
DEFAULT_TOXICITY_HIGH = 0.85
DEFAULT_LOOPING_SEVERITY = "MEDIUM"
SEVERITIES = ("MEDIUM", "HIGH", "CRITICAL")

# Policies are few, so one level of wide buckets is enough for their scans.
_SHIFTS = (20,)
_BLOCK = 16  # blocks of 65,536 numbers or milliseconds

PARSED = T.StructType([T.StructField("seq", T.LongType()), T.StructField("policy", POLICY)])


def _mapping(value) -> dict:
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise ValueError("a policy field must be a mapping")
    return value


def _guardrail(block: dict) -> dict:
    severity = block.get("severity")
    if severity is not None:
        severity = str(severity).upper()
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity}")
    number = lambda v: None if v is None else float(v)
    return {
        "medium": number(block.get("medium")), "high": number(block.get("high")),
        "critical": number(block.get("critical")), "severity": severity,
    }


def _text(value) -> str | None:
    return None if value is None else str(value)


def policy_from_text(text: str | None) -> dict | None:
    """One YAML (or JSON) policy message as a ``POLICY`` row; None when it is not valid."""
    import yaml  # PyYAML; only this function needs it

    loader = getattr(yaml, "CBaseLoader", yaml.BaseLoader)
    try:
        root = _mapping(yaml.load((text or "").replace("\\n", "\n"), Loader=loader))
        defaults = root.get("defaults")
        if not isinstance(defaults, dict):
            return None
        sections = {}
        for name in POLICY_SECTIONS:
            if not isinstance(defaults.get(name), dict):
                return None
            sections[name] = _guardrail(_scalars(defaults[name]))
        agents = {}
        for agent, block in _mapping(_null(root.get("agents"))).items():
            block = _mapping(_null(block))
            agents[str(agent)] = {
                name: _guardrail(_scalars(_mapping(_null(block[name])))) if _null(block.get(name)) is not None else None
                for name in POLICY_SECTIONS
            }
        return {
            "version": _text(_null(root.get("version"))),
            "updatedBy": _text(_null(root.get("updatedBy"))),
            "updatedAt": _text(_null(root.get("updatedAt"))),
            "defaults": sections, "agents": agents,
        }
    except (ValueError, TypeError, yaml.YAMLError):
        return None


def _null(value):
    """The text loader keeps every scalar as written; these spellings mean null."""
    return None if isinstance(value, str) and value in ("", "~", "null", "Null", "NULL") else value


def _scalars(block: dict) -> dict:
    return {k: _null(v) for k, v in block.items()}


def parse_policies(messages: DataFrame) -> DataFrame:
    """``value, seq`` messages to ``seq, policy``; ``policy`` is null for an invalid message.

    The other columns of ``TIME_LINE`` stay where the messages have them.
    """
    arrival = [c for c in TIME_LINE if c != "seq" and c in messages.columns]
    schema = T.StructType([*PARSED.fields, *[messages.schema[c] for c in arrival]])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["seq"]].assign(policy=[policy_from_text(v) for v in batch["value"]], **{c: batch[c] for c in arrival})

    return messages.select("seq", "value", *arrival).mapInPandas(read, schema)


def on_time_line(policies: DataFrame) -> DataFrame:
    """Parsed policies of one or several logs with ``seq`` as their rank in ``TIME_LINE`` and ``at``, their place there.

    Offsets of different partitions say nothing about each other, so the rank takes their place in the order
    in which :func:`decide` goes.
    """
    placed = policies.withColumns({"at": F.struct(*TIME_LINE), "__one": F.lit(1)})
    ranked = running(placed, "ingestMillis", {"__rank": ("sum", "__one")}, shifts=_SHIFTS, ties=TIME_LINE[1:])
    return ranked.select(F.col("__rank").alias("seq"), "policy", "at")


def load_policy(spark: SparkSession, path: str, required: bool = True, seq: int = -1) -> DataFrame:
    """Bootstrap policy document as one parsed row; none when optional and absent."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    if not exists:
        if required:
            raise FileNotFoundError(f"bootstrap policy is missing: {path}")
        return spark.createDataFrame([], PARSED)
    document = spark.read.text(path, wholetext=True).select(
        "value", F.lit(seq).cast("long").alias("seq")
    )
    parsed = parse_policies(document)
    return parsed.withColumn(
        "policy",
        F.when(F.col("policy").isNull(), F.raise_error(F.lit(f"bootstrap policy is not valid: {path}")))
        .otherwise(F.col("policy")),
    )


def policy_literal(
    spark: SparkSession, version: str, updated_at: str | None, defaults: dict, agents: dict | None = None,
    seq: int = -1,
) -> DataFrame:
    """A policy given in code, e.g. the bootstrap of a test or job."""
    empty = {"medium": None, "high": None, "critical": None, "severity": None}
    block = {name: {**empty, **defaults.get(name, {})} for name in POLICY_SECTIONS}
    overrides = {
        agent: {name: ({**empty, **part[name]} if name in part else None) for name in POLICY_SECTIONS}
        for agent, part in (agents or {}).items()
    }
    policy = {"version": version, "updatedBy": None, "updatedAt": updated_at, "defaults": block, "agents": overrides}
    return spark.createDataFrame([(seq, policy)], PARSED)


def decide(policies: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``accepted`` and ``rejection`` to parsed, valid policies in ``seq`` order.

    A policy is compared with the last accepted one: an older ``updatedAt`` loses when
    both have one, a smaller version loses when neither has one, anything else wins.  So
    the sequence falls into islands of equal kind, inside which the last accepted policy
    is the running maximum; rejected ones never exceed it.  The first row is the bootstrap.
    """
    at = instant_millis(F.col("policy.updatedAt"))
    base = policies.where(F.col("policy").isNotNull()).withColumn("__at", at)
    if not settings.reject_older_policies:
        return base.withColumns({"accepted": F.lit(True), "rejection": F.lit(None).cast("string")}).drop("__at")
    timed = F.col("__at").isNotNull()
    marked = base.withColumns({
        "__timed_seq": F.when(timed, F.col("seq")),
        "__untimed_seq": F.when(~timed, F.col("seq")),
        # A missing version also breaks the chain: it is accepted and compares with nothing.
        "__break_seq": F.when(timed | F.col("policy.version").isNull(), F.col("seq")),
    })
    placed = running(marked, "seq", {
        "__last_untimed": ("max", "__untimed_seq"), "__last_break": ("max", "__break_seq"),
    }, shifts=_SHIFTS).withColumn(
        "__island",
        F.when(timed, F.coalesce(F.col("__last_untimed"), F.lit(-1 << 40)))
        .otherwise(F.coalesce(F.col("__last_break"), F.lit(-1 << 40))),
    ).withColumns({
        "__kind": timed,
        "__version": F.when(~timed, F.col("policy.version")),
    })
    seen = running(
        placed, "seq", {"__best_at": ("max", "__at"), "__best_version": ("max", "__version")},
        keys=("__kind", "__island"), inclusive=False, shifts=_SHIFTS,
    )
    older_time = timed & F.coalesce(F.col("__at") < F.col("__best_at"), F.lit(False))
    older_version = ~timed & F.coalesce(F.col("__version") < F.col("__best_version"), F.lit(False))
    reason = F.when(older_time, "older-updatedAt").when(older_version, "older-version")
    return seen.select(
        *policies.columns, (~(older_time | older_version)).alias("accepted"), reason.alias("rejection")
    )


def accepted_timeline(
    bootstrap: DataFrame | None, updates: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Accepted policies; each is in force from its ``seq`` to the next accepted one."""
    everything = updates if bootstrap is None else bootstrap.unionByName(updates, allowMissingColumns=True)
    placed = ["at"] if "at" in everything.columns else []
    return decide(everything, settings).where("accepted").select("seq", "policy", *placed)


def merged_section(policy: Column, agent: Column, section: str) -> Column:
    """One guardrail section for an agent: override over default, field by field."""
    override = F.try_element_at(policy["agents"], agent)[section]
    default = policy["defaults"][section]
    return F.struct(*[
        F.coalesce(override[f], default[f]).alias(f) for f in ("medium", "high", "critical", "severity")
    ])


def effective_policies(policies: DataFrame) -> DataFrame:
    """Every policy resolved for each agent it names and, as agent ``*``, for all others."""
    agents = F.array_union(F.array(F.lit("*")), F.coalesce(F.map_keys("policy.agents"), F.array().cast("array<string>")))
    exploded = policies.select("seq", "policy", F.explode(agents).alias("agentId"))
    policy = F.col("policy")
    flat = []
    for section, fields in (
        ("promptInjection", ("medium", "high", "critical")), ("toxicity", ("medium", "high", "critical")),
        ("looping", ("severity",)), ("systemPromptLeakage", ("severity",)),
    ):
        merged = merged_section(policy, F.col("agentId"), section)
        flat += [merged[f].alias(f"{section}_{f}") for f in fields]
    return exploded.select("seq", policy["version"].alias("version"), "agentId", *flat)


def attach_policy(rows: DataFrame, timeline: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """As-of join: each row gets the last accepted policy at or before its place in ``order``.

    ``order`` is ``("seq",)`` for one log, or ``TIME_LINE`` for rows and policies of several (see :func:`on_time_line`).
    A policy takes effect before the row that shares its place.  Policies rank by ``seq``, so the one in force is a
    maximum of numbers: the largest of earlier blocks, kept as one small row a block, or one of those in the row's
    own block.  Rows meet blocks and then policies in equi-joins, which Spark makes broadcasts where sizes
    allow; rows are not sorted.  Rows before the first policy get null.
    """
    place = F.struct(*order)
    block = F.shiftright(F.col(order[0]).cast("long"), _BLOCK)
    at = F.col("at") if len(order) > 1 else F.struct("seq")
    first = F.col("at")[order[0]] if len(order) > 1 else F.col("seq")
    # A bootstrap has no place in a log: it is there from the start.
    start = F.coalesce(F.shiftright(first.cast("long"), _BLOCK), F.lit(-1))
    changes = timeline.select(start.cast("long").alias("__block"), F.struct(at.alias("at"), F.col("seq").alias("number")).alias("change"))
    blocks = changes.groupBy("__block").agg(F.collect_list("change").alias("__changes"), F.max("change.number").alias("__latest"))
    present = rows.select(block.alias("__block")).distinct().join(blocks, "__block", "full")
    known = running(present, "__block", {"__before": ("max", "__latest")}, inclusive=False, shifts=_SHIFTS)
    inside = F.filter("__changes", lambda c: c["at"].isNull() | (c["at"] <= F.col("__place")))
    number = F.greatest("__before", F.array_max(F.transform(inside, lambda c: c["number"])))
    placed = rows.withColumns({"__block": block, "__place": place}).join(known.select("__block", "__before", "__changes"), "__block", "left")
    return placed.withColumn("__number", number).select(*rows.columns, "__number").join(
        timeline.select(F.col("seq").alias("__number"), "policy"), "__number", "left"
    ).select(*rows.columns, "policy")


def thresholds(policy: Column, agent: Column) -> dict[str, Column]:
    """The values the session rules read, with fallbacks for absent policies and fields."""
    injection = merged_section(policy, agent, "promptInjection")
    toxic = merged_section(policy, agent, "toxicity")
    looping = merged_section(policy, agent, "looping")
    high = F.coalesce(injection["high"], F.lit(DEFAULT_PI_HIGH))
    return {
        "appliedPolicyVersion": F.when(policy.isNull(), F.lit(FALLBACK_VERSION)).otherwise(policy["version"]),
        "piHigh": high,
        "piCritical": F.coalesce(injection["critical"], high),
        "toxicityHigh": F.coalesce(toxic["high"], F.lit(DEFAULT_TOXICITY_HIGH)),
        "loopingSeverity": F.coalesce(looping["severity"], F.lit(DEFAULT_LOOPING_SEVERITY)),
    }
