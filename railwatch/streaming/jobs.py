"""Stream jobs built from the batch operators.

Intake and aggregates run the batch operators on each micro-batch and keep what the next
one needs in small tables, one folder per batch, so that a repeated batch replaces its own
output.  So do campaigns and sessions, whose clusters and states are such tables (see ``state.py``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from railwatch.operators import aggregates, campaigns, correlation, incidents, intake, policies, review
from railwatch.operators.aggregates import AGGREGATE_KEY, WINDOW_KEY
from railwatch.settings import DEFAULTS, MINUTE_MS, Settings
from railwatch.schemas import INCIDENT_FIELDS
from railwatch.sources.staging import discard, ship_package, staged
from railwatch.sources.streams import commit_sinks, read_batches, read_committed, remove_batch, write_batch, write_topic
from railwatch.streaming.state import CONTINUED, FOUND, SESSION, STATE, SessionRules, continue_sessions

NEWEST = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("newest", T.LongType()),
])
HOUR_MS = 60 * MINUTE_MS
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state larger than memory, with incremental checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _start(
    stream: DataFrame, handle, checkpoint: str, mode: str, trigger: dict | None, settings: Settings,
) -> StreamingQuery:
    """Start one job.  At least once, it resumes from its checkpoint after a failure; with the
    guarantee ``NONE`` every start forgets earlier progress."""
    ship_package(stream.sparkSession)
    if settings.delivery_guarantee == "NONE":
        checkpoint = f"{checkpoint}-{uuid.uuid4().hex}"
    return (
        stream.writeStream.foreachBatch(handle).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def _bounded(trigger: dict | None) -> bool:
    return not trigger or "availableNow" in trigger or "once" in trigger


def _idle_ms(trigger: dict | None, settings: Settings) -> int | None:
    return None if _bounded(trigger) else settings.state_idle_ms


def start_intake(
    raw: DataFrame, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None
) -> StreamingQuery:
    """Raw stream to ``normalized``, ``late`` and ``invalid`` tables below ``out``.

    Lateness needs the newest time of earlier rows.  Inside a micro-batch that is the batch
    operator; across batches one small row per source partition is carried, so the routes
    do not depend on where the batches were cut.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = staged(intake.parse(batch), "intake")
        earlier = read_batches(spark, f"{out}/newest", NEWEST, batch_id - 1)
        carry = earlier.groupBy("source", "partition").agg(F.max("newest").alias("newest"))
        valid = intake.valid(parsed)
        marked = intake.with_watermark(valid, settings, carry=carry)
        commit_sinks(spark, out, "intake", batch_id, {
            "normalized": intake.on_time(marked, settings), "late": intake.late(marked, settings),
            "invalid": intake.invalid(parsed), "newest": intake.newest_times(valid),
        })
        discard(parsed)

    return _start(raw, handle, f"{out}/_checkpoints/intake", "append", trigger, settings)


def start_aggregates(
    events: DataFrame, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None,
    emitted_at: Callable[[], int] = lambda: int(time.time() * 1000),
) -> StreamingQuery:
    """Normalised stream to the ``value_counts``, ``aggregates`` and ``quality`` tables below ``out``.

    The partial measures are mergeable, so a micro-batch only adds those of its own rows, in folders
    by the hour of their window, and sums what the touched hours hold.  There is no state that a
    watermark could close: a row counts however late its partition delivers it.  Each micro-batch
    re-emits the windows it touched, with their latencies at ``emitted_at()``, and their quality rows, both under one
    batch number; the last revision of a window equals the batch result.
    """
    base, widest = reduce(gcd, settings.window_sizes_ms), max(settings.window_sizes_ms)
    table = f"{out}/value_counts"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delta = aggregates.value_counts(batch, base).withColumn("hour", F.floor(F.col("baseStart") / HOUR_MS).cast("long"))
        schema = delta.schema
        # One folder per batch and hour: a repeated batch replaces its own.
        delta.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("hour", "batch_id").parquet(table)
        known = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(table)
        fresh = known.where(F.col("batch_id") == batch_id)
        hours = [r["hour"] for r in fresh.select("hour").distinct().collect()]
        if not hours:
            return
        reach = -(-widest // HOUR_MS)
        near = known.where((F.col("batch_id") <= batch_id) & F.col("hour").isin(
            sorted({h + d for h in hours for d in range(-reach, reach + 1)})
        ))
        rows = aggregates.aggregate_value_counts(aggregates.merged_value_counts(near), settings.window_sizes_ms)
        sizes = F.explode(F.array(*[F.lit(s).cast("long") for s in settings.window_sizes_ms]))
        touched = (
            fresh.select(*AGGREGATE_KEY, "baseStart", sizes.alias("size"))
            .select(
                *[F.nullif(F.col(c), F.lit(aggregates.NO_VALUE)).alias(c) for c in AGGREGATE_KEY],
                aggregates.window_name(F.col("size")).alias("windowName"),
                aggregates.window_start(F.col("baseStart"), F.col("size")).alias("windowStartMillis"),
            ).distinct()
        )
        same = reduce(
            lambda a, b: a & b, [rows[c].eqNullSafe(touched[c]) for c in WINDOW_KEY]
        )
        emitted = staged(aggregates.with_emit_latency(rows.join(touched, same, "left_semi"), emitted_at()), "aggregates")
        commit_sinks(spark, out, "aggregates", batch_id, {"aggregates": emitted, "quality": aggregates.quality_metrics(emitted)})
        discard(emitted)

    return _start(events, handle, f"{out}/_checkpoints/aggregates", "append", trigger, settings)


def start_policy_updates(
    messages: DataFrame, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None
) -> StreamingQuery:
    """Policy messages (``value, seq``) to the ``policies`` table below ``out``.

    Invalid messages are kept with a null policy, so that they can be counted.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(policies.parse_policies(batch), f"{out}/policies", batch_id)

    return _start(messages, handle, f"{out}/_checkpoints/policies", "append", trigger, settings)


def current_timeline(
    spark: SparkSession, out: str, bootstrap: DataFrame | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Accepted policies of everything that arrived so far; read again for each micro-batch."""
    updates = read_batches(spark, f"{out}/policies", policies.PARSED).drop("batch_id")
    return policies.accepted_timeline(bootstrap, updates, settings)


MESSAGES = T.StructType([T.StructField("value", T.StringType())])


def _commit_incidents(rows: DataFrame, out: str, job: str, name: str, batch_id: int, topic: tuple[str, str] | None) -> None:
    """Incidents as a table and as JSON messages, and to a message topic ``(servers, topic)`` where one is named."""
    rows = staged(rows, name)
    messages = intake.to_json_rows(rows, INCIDENT_FIELDS)
    commit_sinks(rows.sparkSession, out, job, batch_id, {name: rows, f"{name}_messages": messages})
    if topic is not None:
        write_topic(messages, *topic)
    discard(rows)


def incident_messages(spark: SparkSession, out: str) -> DataFrame:
    """All incidents so far as one table of JSON messages ``value, batch_id``: those of sessions and of campaigns."""
    return read_committed(spark, out, "sessions", "incidents_messages", MESSAGES).unionByName(
        read_committed(spark, out, "campaigns", "campaigns_messages", MESSAGES))


def start_session_incidents(
    events: DataFrame, policies_at, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None,
    topic: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Normalised stream to the ``incidents`` table and its JSON messages below ``out``.

    ``policies_at()`` gives the accepted policies as of the micro-batch (a small table that
    is read again each time), or None.  The state machine decides when a rule emits; the
    policy only sets the severity, in the batch step that follows it.  The states after a micro-batch are in the
    ``session_state`` table, one row a session, which the next one reads; the one before the last is removed.  Sessions
    that were silent for long are freed where the query runs on.
    """
    idle_ms = _idle_ms(trigger, settings)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, int(time.time() * 1000)
        folder = f"{out}/session_state"
        scanned = lambda at, kind: read_batches(spark, folder, CONTINUED).where(
            (F.col("batch_id") == at) & (F.col("kind") == kind))
        found = intake.triggered(batch).withColumn("t", F.col("eventTimeMillis")).select(*SESSION, *FOUND)
        known = scanned(batch_id - 1, "state").select(*STATE.fieldNames())
        if idle_ms is not None:
            known = known.where(F.col("updatedMillis") >= now - idle_ms)
        write_batch(continue_sessions(found, known, now, settings), folder, batch_id)
        emitted = scanned(batch_id, "emitted").select(*SessionRules.OUTPUT.fieldNames())
        _commit_incidents(incidents.incident_rows(emitted, policies_at(), settings), out, "sessions", "incidents", batch_id, topic)
        remove_batch(spark, folder, batch_id - 2)

    return _start(events, handle, f"{out}/_checkpoints/sessions", "append", trigger, settings)


def start_campaigns(
    events: DataFrame, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None, embedder=None,
    topic: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Normalised stream to the ``campaigns`` table and its JSON messages below ``out``.

    The clusters that are alive after a micro-batch are the ``campaign_state`` table, one row a key, which the next one
    reads; the one before the last is removed.  Keys that were silent for long are freed where the query runs on.
    """
    idle_ms = _idle_ms(trigger, settings)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, int(time.time() * 1000)
        folder = f"{out}/campaign_state"
        known = read_batches(spark, folder, campaigns.STATE).where(F.col("batch_id") == batch_id - 1).drop("batch_id")
        if idle_ms is not None:
            known = known.where(F.col("updatedMillis") >= now - idle_ms)
        found = campaigns.embedded_findings(batch, settings.campaigns, embedder)
        scanned = staged(campaigns.continue_campaigns(found, known, now, settings), "campaign-scan")
        state = scanned.where(F.col("kind") == "state").select(*campaigns.STATE.fieldNames())
        write_batch(state, folder, batch_id)
        _commit_incidents(campaigns.campaign_incidents(scanned), out, "campaigns", "campaigns", batch_id, topic)
        discard(scanned)
        remove_batch(spark, folder, batch_id - 2)

    return _start(events, handle, f"{out}/_checkpoints/campaigns", "append", trigger, settings)


def start_request_findings(
    events: DataFrame, out: str, settings: Settings = DEFAULTS, trigger: dict | None = None,
    before_ms: int = 2_000, after_ms: int = 30_000,
) -> StreamingQuery:
    """Pairs of a request and a finding of its session in ``[request - before, request + after]``, below ``out``.

    The stream form of :func:`correlation.request_findings`: both sides have a watermark, twice the time that routing
    lets a row lag, and keep rows until no partner can come any more, so state is bounded by that span.
    """
    use_rocksdb(events.sparkSession)
    delay = f"{2 * (settings.late_tolerance_ms + settings.out_of_orderness_ms)} milliseconds"
    asked, found = correlation.request_sides(events.withColumn("event_time", F.timestamp_millis("eventTimeMillis")))
    asked = asked.withWatermark("requestTime", delay)
    found = found.withWatermark("findingTime", delay).withColumnsRenamed({c: f"_{c}" for c in correlation.SESSION})
    near = F.expr(f"findingTime >= requestTime - INTERVAL {before_ms} MILLISECOND AND findingTime <= requestTime + INTERVAL {after_ms} MILLISECOND")
    same = reduce(lambda a, b: a & b, [asked[c] == found[f"_{c}"] for c in correlation.SESSION])
    pairs = asked.join(found, same & near).select(*correlation.PAIR)

    def handle(batch: DataFrame, batch_id: int) -> None:
        commit_sinks(batch.sparkSession, out, "request_findings", batch_id, {"request_findings": batch})

    return _start(pairs, handle, f"{out}/_checkpoints/request_findings", "append", trigger, settings)


def start_affected_sessions(
    events: DataFrame, out: str, size_ms: int, settings: Settings = DEFAULTS, trigger: dict | None = None,
) -> StreamingQuery:
    """Distinct sessions with a triggered finding per agent and window, below ``out``.

    Sessions of a window come in many micro-batches, so each adds a mergeable sketch, in folders by the hour of the
    window, and re-emits the windows it touched from all sketches of their hours.
    """
    table = f"{out}/session_sketches"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delta = review.affected_sketches(batch, size_ms).withColumn("hour", F.floor(F.col("windowStartMillis") / HOUR_MS).cast("long"))
        delta.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("hour", "batch_id").parquet(table)
        known = spark.read.schema(T.StructType([*delta.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(table)
        fresh = known.where(F.col("batch_id") == batch_id).select("agentId", "windowStartMillis", "hour")
        hours = [r["hour"] for r in fresh.select("hour").distinct().collect()]
        near = known.where((F.col("batch_id") <= batch_id) & F.col("hour").isin(hours))
        touched = near.join(fresh.drop("hour"), ["agentId", "windowStartMillis"], "left_semi")
        commit_sinks(spark, out, "affected_sessions", batch_id, {"affected_sessions": review.merged_sketches(touched)})

    return _start(events, handle, f"{out}/_checkpoints/affected_sessions", "append", trigger, settings)
