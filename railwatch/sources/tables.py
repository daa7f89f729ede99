"""Safety telemetry derived from the benchmark tables.

The tables hold no guardrail findings, so every column of a raw event is a fixed function
of an ``events`` row, and every policy update a fixed function of a ``supplier`` row.  The
JSON and YAML text is built by Spark, so the work of every query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railwatch.schemas import (
    FINDING, LEAKAGE, LOOPING, PROMPT_INJECTION, REQUEST, RESPONSE, TOXICITY,
)

# Fixed values of the derivation.
T0_MILLIS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
COMPRESSION_MICROS = 240_000  # one month of table time becomes three hours
POLICY_T0_SECONDS = 1_787_702_400  # 2026-08-26T00:00:00Z

# So many events in a row take their evidence from the turns of one conversation.
EVIDENCE_BURST = 128
REQUESTS_PER_USER = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc_micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp read as UTC, whatever the session zone is."""
    return F.unix_micros(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def _pick(index: Column, options: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), index.cast("int") + 1)


def raw_events(events: DataFrame, conversations: DataFrame) -> DataFrame:
    """``value, source, partition, seq, ingestMillis`` from the ``events`` table (batch or stream).

    Evidence comes from all conversations in turn: ``EVIDENCE_BURST`` events in a row share one, by its
    number, and each takes a turn of it by its own number.
    """
    turns = conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    texts = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("text").alias("evidence"))
    conversation = F.floor(F.col("event_id") / EVIDENCE_BURST) % conversations.agg(F.max("conv_id") + 1).scalar()
    # Only the rows with evidence meet the conversations: all others have no key, and a join would deal them to one task.
    told = F.coalesce(F.col("event_type") == "error", F.lit(False))
    with_text = events.where(told).withColumn("conv_id", conversation).join(
        turns, "conv_id", "left"
    ).withColumn("turn", F.col("event_id") % F.col("turns")).join(texts, ["conv_id", "turn"], "left")
    events = with_text.select(*events.columns, "evidence").unionByName(
        events.where(~told).withColumn("evidence", F.lit(None).cast("string")))
    # One task reads a row group, and a file may have a single one; dealt out, the rows become text and are parsed in all tasks.
    # In a given number of parts, since Spark merges parts by their bytes, which the texts exceed many times. Bursts stay
    # together, so that later exchanges pack as well as before.
    spark = events.sparkSession
    events = events.repartition(
        max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism),
        F.floor(F.col("event_id") / EVIDENCE_BURST), F.when(F.col("event_id").isNull(), F.col("ts")))
    kind, k = F.col("event_type"), F.col("k")
    base = events.select(
        "event_id", "user_id", "event_type", "value", "evidence",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        _utc_micros(F.col("ts")).alias("us"),
    )
    shift = F.when(k == 7, F.lit(45_000)).when(k == 8, F.lit(360_000)).otherwise(F.lit(0))
    millis = (
        F.lit(T0_MILLIS)
        + F.floor((F.col("us") - F.lit(T0_MILLIS * 1000)) / F.lit(COMPRESSION_MICROS))
        - shift
    )
    guardrail = (
        F.when(kind == "error", PROMPT_INJECTION).when(kind == "purchase", TOXICITY)
        .when(kind == "signup", LOOPING).when(kind == "view", LEAKAGE)
    )
    version = (
        F.when(kind == "error", "pi-v1").when(kind == "purchase", "tox-v1")
        .when(kind == "signup", "loop-v1").when(kind == "view", "spl-v1")
    )
    event_type = (
        F.when(kind != "click", FINDING)
        .when(F.col("event_id") % 2 == 0, REQUEST).otherwise(RESPONSE)
    )
    score = (F.round(F.col("value") * 100).cast("long") % 10_000) / F.lit(10_000.0)
    is_finding = kind != "click"
    fields = F.struct(
        F.when(k == 14, F.lit("AGENT_PING")).otherwise(event_type).alias("eventType"),
        F.concat(F.lit("tenant-"), F.col("user_id") % 8).alias("tenantId"),
        F.concat(F.lit("agent-"), F.col("user_id") % 4).alias("agentId"),
        F.when(k != 9, F.concat(F.lit("session-"), F.col("user_id"))).alias("sessionId"),
        F.concat(F.lit("req-"), F.col("user_id"), F.lit("-"), F.col("event_id") % REQUESTS_PER_USER).alias("requestId"),
        F.concat(F.lit("turn-"), F.col("event_id")).alias("turnId"),
        F.when(k == 10, F.lit("yesterday")).otherwise(
            F.concat(
                F.date_format(
                    F.to_utc_timestamp(F.timestamp_millis(F.col("ms")), F.current_timezone()),
                    "yyyy-MM-dd'T'HH:mm:ss.SSS",
                ),
                F.lit("Z"),
            )
        ).alias("eventTime"),
        F.lit("gpt-4.1-mini").alias("modelName"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("userId"),
        F.lit("web").alias("channel"),
        (150 + F.col("event_id") % 120).alias("inputTokens"),
        (250 + F.col("event_id") % 220).alias("outputTokens"),
        F.when(k != 11, guardrail).alias("guardrailName"),
        version.alias("guardrailVersion"),
        F.lit("policy-v1").alias("policyVersion"),
        F.when((k != 12) & kind.isin("error", "purchase"), score).alias("confidence"),
        F.when((k != 13) & is_finding, score >= 0.40).alias("triggered"),
        (5 + k).alias("detectorLatencyMs"),
        F.when(k % 12 == 0, F.lit("ERROR")).otherwise(F.lit("OK")).alias("detectorStatus"),
        F.col("evidence").alias("evidenceSnippet"),
    )
    topic = (
        F.when(kind != "click", "guardrail-findings")
        .when(F.col("event_id") % 2 == 0, "agent-requests").otherwise("agent-responses")
    )
    return base.withColumns({"ms": millis, "shift": shift}).select(
        F.when(k == 15, F.lit('{"eventType": "AGENT_REQUEST", "agentId')).otherwise(
            F.to_json(fields)
        ).alias("value"),
        topic.alias("source"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("seq"),
        (F.col("ms") + F.col("shift")).cast("long").alias("ingestMillis"),
    )


def policy_topic(suppliers: DataFrame) -> DataFrame:
    """The messages of :func:`policy_updates` as a topic of two partitions whose offsets overlap.

    ``value, source, partition, seq, ingestMillis``: ``seq`` is the offset, and messages arrive in another order
    than that of their numbers.
    """
    i = F.floor(F.col("seq") / 100)
    return policy_updates(suppliers).select(
        "value", F.lit("policy-updates").alias("source"), (i % 2).cast("int").alias("partition"), F.floor(i / 2).alias("seq"),
        (F.lit(T0_MILLIS) + (i * 7_919_000) % 10_800_000).cast("long").alias("ingestMillis"),
    )


def policy_updates(suppliers: DataFrame) -> DataFrame:
    """``value, seq``: one YAML policy message per supplier, line breaks escaped.

    About a seventh lacks a required section, some are not YAML, a fifth carries no
    ``updatedAt`` and many are older than a predecessor.
    """
    i, c = F.col("i"), F.col("c")
    two = lambda n: F.format_string("0.%02d", n)
    minutes = i * 10 + c % 61 - 30
    stamp = F.concat(
        F.date_format(
            F.to_utc_timestamp(
                F.timestamp_seconds(F.lit(POLICY_T0_SECONDS) + minutes * 60), F.current_timezone()
            ),
            "yyyy-MM-dd'T'HH:mm:ss",
        ),
        F.lit("Z"),
    )
    line = lambda indent, *parts: F.concat(
        F.lit(" " * indent), *[p if isinstance(p, Column) else F.lit(p) for p in parts], F.lit("\\n")
    )
    text = F.concat(
        line(0, 'version: "policy-v', F.format_string("%03d", c), "-", i.cast("string"), '"'),
        line(0, 'updatedBy: "ops"'),
        F.when(F.col("s_nationkey") % 5 != 0, line(0, 'updatedAt: "', stamp, '"')).otherwise(F.lit("")),
        line(0, "defaults:"),
        line(2, "promptInjection:"),
        line(4, "medium: 0.55"),
        line(4, "high: ", two(60 + c % 30)),
        line(4, "critical: ", two(85 + c % 10)),
        F.when(
            F.col("s_nationkey") % 7 != 6,
            F.concat(line(2, "toxicity:"), line(4, "high: ", two(50 + c % 45))),
        ).otherwise(F.lit("")),
        line(2, "looping:"),
        line(4, "severity: ", _pick(i % 3, ("medium", "HIGH", "critical"))),
        line(2, "systemPromptLeakage:"),
        line(4, 'severity: "CRITICAL"'),
        line(0, "agents:"),
        line(2, "agent-", (i % 4).cast("string"), ":"),
        line(4, "promptInjection:"),
        line(6, "high: ", two(50 + c % 40)),
        F.when(i % 2 == 0, line(6, "critical: ", two(80 + c % 15))).otherwise(F.lit("")),
    )
    broken = (F.col("s_nationkey") % 7 == 5) & (i % 2 == 1)
    return suppliers.select(
        F.col("s_suppkey").alias("i"), "s_nationkey",
        F.pmod(F.round(F.col("s_acctbal") * 100).cast("long"), F.lit(1000)).alias("c"),
    ).select(
        F.when(broken, F.lit("version: [policy\\ndefaults: {")).otherwise(text).alias("value"),
        (i * 100 + 50).alias("seq"),
    )
