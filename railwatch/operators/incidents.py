"""Session incidents: rules over the triggered findings of one (agent, session).

Canonical order inside a session is ``(eventTimeMillis, seq)``.  A session may hold a third
of all findings, so it is never scanned in one task.  Time is cut into blocks as wide as the
PI_AND_TOXIC look-back:

* block totals (one small row per session and block) give inactivity gaps, epochs and the
  running values at the start of each block;
* rows are scanned inside ``(agent, session, block)`` only, and the carry is added;
* the look-back reaches at most into the previous block, whose injections and toxic
  findings are copied into the scan as rows that expire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railwatch.functions import non_blank
from railwatch.operators.intake import triggered
from railwatch.operators.policies import attach_policy, thresholds
from railwatch.operators.scan import running
from railwatch.schemas import (
    BURST_RULE, INCIDENT_FIELDS, LEAK_RULE, LEAKAGE, LOOP_RULE, LOOPING, MIXED_RULE,
    POLICY, PROMPT_INJECTION, SESSION_RULES, TOXIC_RULE, TOXICITY,
)
from railwatch.settings import DEFAULTS, Settings

SESSION = ["agentId", "sessionId"]
_GUARDRAILS = {"pi": PROMPT_INJECTION, "tox": TOXICITY, "loop": LOOPING, "leak": LEAKAGE}
_LISTS = {
    "requestIds": "requestId", "guardrailNames": "guardrailName",
    "guardrailVersions": "guardrailVersion", "policyVersions": "policyVersion",
}
EMITTED_FIELDS = (
    *SESSION, "tenantId", "ruleName", "revision", "t", "seq", "first_t", "last_t",
    *[f"n_{k}" for k in ("all", *_GUARDRAILS)], "max_pi", "max_tox",
    "win_pi", "win_tox", "winmax_pi", "winmax_tox",
)
_RUNNING_START = (Window.unboundedPreceding, Window.currentRow)


def _blocked(events: DataFrame, settings: Settings) -> DataFrame:
    t = F.col("eventTimeMillis")
    return triggered(events).select(
        *SESSION, "tenantId", "requestId", t.alias("t"), "seq", "guardrailName",
        "guardrailVersion", "policyVersion", "confidence",
        F.floor(t / F.lit(settings.pi_and_toxic_window_ms)).alias("block"),
    )


def session_blocks(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Totals per (agent, session, block) with epoch number and carried running values."""
    name = F.col("guardrailName")
    counts = [F.count_if(name == v).alias(f"n_{k}") for k, v in _GUARDRAILS.items()]
    maxima = [F.max(F.when(name == _GUARDRAILS[k], F.col("confidence"))).alias(f"max_{k}") for k in ("pi", "tox")]
    totals = _blocked(events, settings).groupBy(*SESSION, "block").agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count(F.lit(1)).alias("n_all"),
        *counts, *maxima,
    )
    in_time = Window.partitionBy(*SESSION).orderBy("block")
    gap = F.col("first_t") - F.lag("last_t").over(in_time)
    numbered = totals.withColumn(
        "epoch_start", F.coalesce((gap > settings.session_timeout_ms).cast("int"), F.lit(0))
    ).withColumn("epoch", F.sum("epoch_start").over(in_time.rowsBetween(*_RUNNING_START)))
    before = (
        Window.partitionBy(*SESSION, "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    through = Window.partitionBy(*SESSION, "epoch")
    carry = {f"c_{k}": F.coalesce(F.sum(f"n_{k}").over(before), F.lit(0)) for k in ("all", *_GUARDRAILS)}
    carry |= {f"c_max_{k}": F.max(f"max_{k}").over(before) for k in ("pi", "tox")}
    return numbered.withColumns(carry).withColumn(
        "epoch_first_t", F.min("first_t").over(through)
    ).drop("epoch_start")


def session_epochs(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per session lifetime; a gap over the inactivity timeout starts a new one."""
    return session_blocks(events, settings).groupBy(*SESSION, "epoch").agg(
        F.min("first_t").alias("firstEventTimeMillis"),
        F.max("last_t").alias("lastEventTimeMillis"),
        F.sum("n_all").alias("triggeredFindingsCount"),
        F.sum("n_pi").alias("promptInjectionCount"),
        F.sum("n_tox").alias("toxicityCount"),
        F.sum("n_loop").alias("loopingCount"),
        F.sum("n_leak").alias("systemPromptLeakageCount"),
        F.max("max_pi").alias("maxPromptInjectionConfidence"),
        F.max("max_tox").alias("maxToxicityConfidence"),
    )


def _qualified(kind: str, settings: Settings) -> Column:
    """Evidence rows of the look-back rule."""
    minimum = {
        "pi": settings.pi_and_toxic_min_injection_confidence,
        "tox": settings.pi_and_toxic_min_toxicity_confidence,
    }[kind]
    is_kind = F.col("guardrailName") == _GUARDRAILS[kind]
    if minimum is not None:
        is_kind = is_kind & (F.col("confidence") >= minimum)
    return F.coalesce(is_kind, F.lit(False))


def session_state(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Every triggered finding with the session state right after it was recorded."""
    look_back = settings.pi_and_toxic_window_ms
    rows = _blocked(events, settings)
    # A finding of the look-back rule also enters the next block, where it counts until it
    # expires.  One explode instead of a union keeps it a single read of the input.
    evidence = F.col("guardrailName").isin(PROMPT_INJECTION, TOXICITY)
    copies = F.when(evidence, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1)))
    spread = rows.select("*", F.explode(copies).alias("own"))
    own = F.col("own") == 1
    # A copy is only counted, so it carries no texts through the exchange.
    texts = ("tenantId", "requestId", "guardrailVersion", "policyVersion")
    spread = spread.withColumns({
        **{c: F.when(own, F.col(c)) for c in texts},
        "block": F.when(own, F.col("block")).otherwise(F.col("block") + 1),
        "at": F.when(own, F.col("t")).otherwise(F.col("t") + look_back + 1),
    })

    part = Window.partitionBy(*SESSION, "block")
    forward = part.orderBy("at", "own", "seq").rowsBetween(*_RUNNING_START)
    backward = part.orderBy(F.desc("at"), F.desc("own"), F.desc("seq")).rowsBetween(*_RUNNING_START)

    name = F.col("guardrailName")
    local = {"l_all": F.count_if(own).over(forward)}
    for k, v in _GUARDRAILS.items():
        local[f"l_{k}"] = F.count_if(own & (name == v)).over(forward)
    for k in ("pi", "tox"):
        fits = _qualified(k, settings)
        local[f"l_max_{k}"] = F.max(F.when(own & (name == _GUARDRAILS[k]), F.col("confidence"))).over(forward)
        local[f"l_win_{k}"] = F.count_if(own & fits).over(forward)
        local[f"l_winmax_{k}"] = F.max(F.when(own & fits, F.col("confidence"))).over(forward)
        # Copies that sort after the row have not expired yet.
        local[f"p_win_{k}"] = F.count_if(~own & fits).over(backward)
        local[f"p_winmax_{k}"] = F.max(F.when(~own & fits, F.col("confidence"))).over(backward)
    scanned = spread.withColumns(local).where(own)

    carry = session_blocks(events, settings).select(
        *SESSION, "block", "epoch", "epoch_first_t",
        *[f"c_{k}" for k in ("all", *_GUARDRAILS)], "c_max_pi", "c_max_tox",
    )
    none = F.lit(-1.0)
    return scanned.join(carry, [*SESSION, "block"]).select(
        *SESSION, "epoch", "block", "t", "seq", "tenantId", "requestId", "guardrailName",
        "guardrailVersion", "policyVersion", "confidence",
        F.col("epoch_first_t").alias("first_t"), F.col("t").alias("last_t"),
        *[(F.col(f"c_{k}") + F.col(f"l_{k}")).alias(f"n_{k}") for k in ("all", *_GUARDRAILS)],
        *[
            F.coalesce(F.greatest(f"c_max_{k}", f"l_max_{k}"), none).alias(f"max_{k}")
            for k in ("pi", "tox")
        ],
        *[(F.col(f"l_win_{k}") + F.col(f"p_win_{k}")).alias(f"win_{k}") for k in ("pi", "tox")],
        *[
            F.coalesce(F.greatest(f"l_winmax_{k}", f"p_winmax_{k}"), none).alias(f"winmax_{k}")
            for k in ("pi", "tox")
        ],
    )


def _rule_conditions(settings: Settings) -> list[tuple[str, Column]]:
    """Rules in evaluation order.  Without updates the counting rules keep only the row at
    which the count reaches its minimum, so almost nothing reaches the next shuffle."""
    name = F.col("guardrailName")
    once = not settings.emit_updates
    reached = lambda c, k: (F.col(c) == k) if once else (F.col(c) >= k)
    leak = (name.isin(PROMPT_INJECTION, LEAKAGE)) & (F.col("n_pi") >= 1) & (F.col("n_leak") >= 1)
    if once:
        leak = leak & (
            ((name == PROMPT_INJECTION) & (F.col("n_pi") == 1)) | ((name == LEAKAGE) & (F.col("n_leak") == 1))
        )
    rules = [
        (BURST_RULE, (name == PROMPT_INJECTION) & reached("n_pi", max(1, settings.injection_burst_min))),
        (TOXIC_RULE, (name == TOXICITY) & reached("n_tox", max(1, settings.toxicity_campaign_min))),
        (LEAK_RULE, leak),
        (LOOP_RULE, (name == LOOPING) & reached("n_loop", max(1, settings.looping_min))),
    ]
    if settings.pi_and_toxic_enabled:
        rules.append((
            MIXED_RULE,
            name.isin(PROMPT_INJECTION, TOXICITY)
            & (F.col("win_pi") >= settings.pi_and_toxic_min_injections)
            & (F.col("win_tox") >= settings.pi_and_toxic_min_toxic),
        ))
    return rules


def emissions(state: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """State rows at which a rule emits, with ``ruleName``, ``rule_rank`` and ``revision``."""
    rules = _rule_conditions(settings)
    fired = F.filter(
        F.array(*[F.when(condition, F.lit(rule)) for rule, condition in rules]), lambda r: r.isNotNull()
    )
    exploded = state.select("*", F.explode(fired).alias("ruleName"))
    epoch = [*SESSION, "epoch", "ruleName"]
    if settings.emit_updates:
        # The revision is a running count, again block by block with a carry.
        per_block = exploded.groupBy(*epoch, "block").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy(*epoch).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        carry = per_block.select(*epoch, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
        local = Window.partitionBy(*epoch, "block").orderBy("t", "seq")
        emitted = (
            exploded.withColumn("local", F.row_number().over(local)).join(carry, [*epoch, "block"])
            .withColumn("revision", (F.col("earlier") + F.col("local")).cast("int")).drop("earlier", "local")
        )
    else:
        payload = [c for c in exploded.columns if c not in (*epoch, "t", "seq")]
        first = F.min(F.struct("t", "seq", *payload)).alias("first")
        emitted = exploded.groupBy(*epoch).agg(first).select(
            *epoch, "first.*", F.lit(1).alias("revision")
        )
    ranks = {rule: i for i, rule in enumerate(SESSION_RULES)}
    rank = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return emitted.withColumn("rule_rank", rank[F.col("ruleName")])


def _first_seen(state: DataFrame) -> DataFrame:
    """``kind, value, at`` for every distinct value of four columns of an epoch: the place of its first finding."""
    values = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in _LISTS.values()
    ]))
    return (
        state.select(*SESSION, "epoch", "n_all", values.alias("v"))
        .where(non_blank(F.col("v.value")))
        .groupBy(*SESSION, "epoch", F.col("v.kind").alias("kind"), F.col("v.value").alias("value"))
        .agg(F.min("n_all").alias("at"))
    )


def incident_members(state: DataFrame) -> DataFrame:
    """What the incidents of a session lifetime name, as rows in first-seen order.

    ``kind, value, firstFinding, rank``: an incident that counts ``triggeredFindingsCount`` findings names the values
    with ``firstFinding`` up to that, so members are written once however many incidents and revisions name them, and
    no row grows with a session.  Ranks are prefix counts of blocks.  With ``list_members`` off in the settings incidents
    have no lists beside this table.
    """
    ranked = running(
        _first_seen(state).withColumn("__one", F.lit(1)), "at", {"rank": ("sum", "__one")}, (*SESSION, "epoch", "kind"),
    )
    return ranked.select(*SESSION, "epoch", "kind", "value", F.col("at").alias("firstFinding"), "rank")


def first_seen_lists(state: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per epoch, the distinct values of four columns in first-seen order, with their rank.

    The order key is ``n_all``, the place of a finding in its epoch.  Request ids are cut if
    the settings limit them (later ids are then never recorded); the other lists are complete.
    """
    seen = _first_seen(state)
    kept = seen if settings.max_request_ids is None else _first_ids(seen, settings.max_request_ids)
    item = F.struct("at", "value")
    return kept.groupBy(*SESSION, "epoch").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("kind") == k, item))).alias(f"all_{k}") for k in _LISTS.values()
    ])


def _first_ids(seen: DataFrame, limit: int) -> DataFrame:
    # The rank limit is applied inside each task before the shuffle as well.
    ranked = seen.where(F.col("kind") == "requestId").withColumn(
        "rank", F.row_number().over(Window.partitionBy(*SESSION, "epoch").orderBy("at"))
    ).where(F.col("rank") <= limit).drop("rank")
    return ranked.unionByName(seen.where(F.col("kind") != "requestId"))


def _score(c: Column) -> Column:
    return F.when(c < 0, F.lit("n/a")).otherwise(F.format_string("%.3f", c))


def _summary() -> Column:
    rule, text = F.col("ruleName"), lambda c: F.col(c).cast("string")
    return (
        F.when(rule == BURST_RULE, F.concat(
            F.lit("Prompt injection burst detected: findings="), text("n_pi"),
            F.lit(", maxConfidence="), _score(F.col("max_pi"))))
        .when(rule == TOXIC_RULE, F.concat(
            F.lit("Toxicity campaign detected: findings="), text("n_tox"),
            F.lit(", maxConfidence="), _score(F.col("max_tox"))))
        .when(rule == LEAK_RULE, F.concat(
            F.lit("Prompt injection combined with system prompt leakage: promptInjectionFindings="),
            text("n_pi"), F.lit(", leakageFindings="), text("n_leak")))
        .when(rule == LOOP_RULE, F.concat(
            F.lit("Looping persistence detected: occurrences="), text("n_loop")))
        .otherwise(F.concat(
            F.lit("PI_AND_TOXIC detected: promptInjectionFindings="), text("win_pi"),
            F.lit(", toxicityFindings="), text("win_tox"),
            F.lit(", maxPromptInjectionConfidence="), _score(F.col("winmax_pi")),
            F.lit(", maxToxicityConfidence="), _score(F.col("winmax_tox"))))
    )


def _severity(limits: dict[str, Column], settings: Settings) -> Column:
    rule = F.col("ruleName")
    looping = limits["loopingSeverity"]
    escalated = F.col("n_loop") >= max(1, settings.looping_min) * 2
    return (
        F.when(rule == BURST_RULE, F.when(F.col("max_pi") >= limits["piHigh"], "HIGH").otherwise("MEDIUM"))
        .when(rule == TOXIC_RULE, F.when(F.col("max_tox") >= limits["toxicityHigh"], "HIGH").otherwise("MEDIUM"))
        .when(rule == LEAK_RULE, F.when(F.col("max_pi") >= limits["piCritical"], "CRITICAL").otherwise("HIGH"))
        .when(rule == LOOP_RULE, F.when(escalated & (looping == "MEDIUM"), "HIGH").otherwise(looping))
        .otherwise(F.lit(settings.pi_and_toxic_severity))
    )


def session_incidents(
    events: DataFrame, timeline: DataFrame | None = None, settings: Settings = DEFAULTS,
    rules: tuple[str, ...] = SESSION_RULES, state: DataFrame | None = None,
    emitted: DataFrame | None = None,
) -> DataFrame:
    """Incident rows of the session rules under the policies of ``timeline``.

    Severity depends on the policy, the decision to emit does not, so policies are attached
    to the few emitted rows only.  ``state`` and ``emitted`` are read several times here: a
    job passes its staged tables, otherwise they are computed for each use.
    """
    if state is None:
        state = session_state(events, settings)
    if emitted is None:
        emitted = emissions(state, settings)
    emitted = emitted.where(F.col("ruleName").isin(*rules))
    if not settings.list_members:
        none = F.array().cast("array<string>")
        return incident_rows(emitted.select(*EMITTED_FIELDS, *[none.alias(out) for out in _LISTS]), timeline, settings)
    lists = first_seen_lists(state, settings)
    listed = {
        out: F.transform(
            F.filter(F.col(f"all_{kind}"), lambda x: x["at"] <= F.col("n_all")), lambda x: x["value"]
        )
        for out, kind in _LISTS.items()
    }
    complete = emitted.join(lists, [*SESSION, "epoch"], "left").select(
        *EMITTED_FIELDS, *[c.alias(out) for out, c in listed.items()]
    )
    return incident_rows(complete, timeline, settings)


def incident_rows(emitted: DataFrame, timeline: DataFrame | None, settings: Settings = DEFAULTS) -> DataFrame:
    """Incident rows of emissions that carry their lists, judged by the policy in force."""
    if timeline is None:
        ruled = emitted.withColumn("policy", F.lit(None).cast(POLICY))
    else:
        ruled = attach_policy(emitted, timeline)
    limits = thresholds(F.col("policy"), F.col("agentId"))
    no_texts = F.array().cast("array<string>")
    incident = ruled.select(
        F.concat_ws("|", "agentId", "sessionId", "ruleName", F.col("first_t").cast("string")).alias("incidentId"),
        "tenantId", "agentId", "sessionId", "ruleName",
        _severity(limits, settings).alias("severity"),
        *_LISTS,
        no_texts.alias("sessionIds"), no_texts.alias("evidenceSnippets"),
        F.lit(None).cast("string").alias("embeddingModelVersion"),
        limits["appliedPolicyVersion"].alias("appliedPolicyVersion"),
        F.col("first_t").alias("firstEventTimeMillis"),
        F.col("last_t").alias("lastEventTimeMillis"),
        F.col("t").alias("emittedAtEventTimeMillis"),
        F.col("n_all").alias("triggeredFindingsCount"),
        F.col("revision").alias("emissionRevision"),
        _summary().alias("summary"),
    )
    return incident.select(*INCIDENT_FIELDS)


def open_sessions(events: DataFrame, as_of_ms: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Session lifetimes that are still open at ``as_of_ms`` (a column of the epochs)."""
    return session_epochs(events, settings).where(
        F.col("lastEventTimeMillis") + settings.session_timeout_ms > as_of_ms
    )
