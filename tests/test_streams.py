import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from railwatch.operators import aggregates, campaigns, incidents, intake
from railwatch.plans.pipeline import Pipeline, flat
from railwatch.settings import Settings
from railwatch.sources.staging import new_path
from railwatch.sources.streams import read_raw_stream
from railwatch.streaming import jobs
from railwatch.streaming.state import Recent, SessionProcessor

SF = "/root/testdata/sf0.001"
PIECES = 4


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """Raw rows in arrival order as four files, and the batch pipeline over the same rows."""
    folder = tmp_path_factory.mktemp("stream")
    pipeline = Pipeline(spark, SF, Settings(emit_updates=True))
    raw = pipeline.raw
    top = raw.agg(F.max("seq")).first()[0] + 1
    for i in range(PIECES):
        part = raw.where((F.col("seq") >= top * i // PIECES) & (F.col("seq") < top * (i + 1) // PIECES))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    out = f"{folder}/out"
    source = read_raw_stream(spark, f"{folder}/raw", schema=raw.schema, files_per_trigger=1)
    query = jobs.start_intake(source, out, pipeline.settings)
    query.awaitTermination()
    assert query.lastProgress["batchId"] == PIECES - 1
    return pipeline, out


def same(a, b):
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    a, b = a.select(names), b.select(names)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    return a.count()


def stream(spark, pipeline, out):
    return (
        spark.readStream.schema(pipeline.events.schema).option("maxFilesPerTrigger", 3).parquet(f"{out}/normalized")
    )


def test_intake_does_not_depend_on_batches(spark, streamed):
    pipeline, out = streamed
    read = lambda name: spark.read.parquet(f"{out}/{name}").drop("batch_id")
    assert same(read("normalized"), pipeline.events) > 900
    assert same(read("late"), intake.late(pipeline.watermarked)) > 0
    assert same(read("invalid"), intake.invalid(pipeline.parsed)) > 0


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    from railwatch.sources.streams import read_batches, write_batch

    frame = spark.range(3)
    write_batch(frame, f"{tmp_path}/t", 0)
    write_batch(frame, f"{tmp_path}/t", 0)
    write_batch(frame, f"{tmp_path}/t", 1)
    assert read_batches(spark, f"{tmp_path}/t", frame.schema).count() == 6
    assert read_batches(spark, f"{tmp_path}/t", frame.schema, 0).count() == 3


def test_aggregates_end_like_the_batch(spark, streamed):
    pipeline, out = streamed
    jobs.start_aggregates(stream(spark, pipeline, out), out, pipeline.settings).awaitTermination()
    emissions = spark.read.parquet(f"{out}/aggregates").select(*aggregates.AGGREGATE_FIELDS)
    final = aggregates.latest_aggregates(emissions)
    rounded = lambda df: df.withColumns({
        c: F.round(c, 9) for c in ("avgConfidence", "avgDetectorLatencyMs")
    })
    assert same(rounded(final), rounded(pipeline.aggregates)) > 500
    assert emissions.count() > final.count()  # windows were emitted again


def test_sessions_end_like_the_batch(spark, streamed):
    pipeline, out = streamed
    jobs.start_session_incidents(
        ordered_stream(spark, pipeline, out), lambda: pipeline.timeline, out, pipeline.settings
    ).awaitTermination()
    got = flat(spark.read.parquet(f"{out}/incidents").drop("batch_id"))
    assert same(got, flat(pipeline.incidents())) > 50


def test_campaigns_end_like_the_batch(spark, streamed):
    pipeline, out = streamed
    eager = Settings(emit_updates=True, campaigns=pipeline.settings.campaigns.__class__(
        min_unique_requests=2, min_distinct_sessions=1, window_ms=1_800_000))
    jobs.start_campaigns(ordered_stream(spark, pipeline, out), out, eager).awaitTermination()
    got = flat(spark.read.parquet(f"{out}/campaigns").drop("batch_id"))
    found = campaigns.embedded_findings(pipeline.events, eager.campaigns)
    expected = flat(campaigns.campaign_incidents(campaigns.scan_campaigns(found, eager)))
    assert same(got, expected) > 3


def ordered_stream(spark, pipeline, out):
    """Files in event-time order: what arrives out of order is order-dependent by contract."""
    folder = f"{out}/ordered"
    from railwatch.sources.staging import path_exists

    if not path_exists(spark, folder):
        rows = pipeline.events
        low, high = rows.agg(F.min("eventTimeMillis"), F.max("eventTimeMillis")).first()
        for i in range(PIECES):
            a, b = low + (high + 1 - low) * i // PIECES, low + (high + 1 - low) * (i + 1) // PIECES
            rows.where((F.col("eventTimeMillis") >= a) & (F.col("eventTimeMillis") < b)).coalesce(1).write.mode(
                "append").parquet(folder)
    return spark.readStream.schema(pipeline.events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_policy_updates_arrive_as_a_stream(spark, streamed, tmp_path):
    pipeline, _ = streamed
    for part in ("seq < 400", "seq >= 400"):
        pipeline.policy_messages.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/messages")
    messages = read_raw_stream(spark, f"{tmp_path}/messages", schema=pipeline.policy_messages.schema, files_per_trigger=1)
    jobs.start_policy_updates(messages, f"{tmp_path}/out").awaitTermination()
    got = jobs.current_timeline(spark, f"{tmp_path}/out", pipeline.bootstrap)
    version = F.col("policy.version").alias("version")
    assert same(got.select("seq", version), pipeline.timeline.select("seq", version)) > 2
    empty = jobs.current_timeline(spark, f"{tmp_path}/none", pipeline.bootstrap)
    assert [r.seq for r in empty.collect()] == [-1]


def test_session_state_forgets_after_the_timeout(spark, streamed):
    pipeline, out = streamed
    epochs = incidents.session_epochs(pipeline.events)
    assert epochs.where("epoch > 0").count() > 0  # the comparison above covers expiry


INJECTION, LOOP = "PROMPT_INJECTION", "LOOPING"


def test_rows_out_of_order_reach_their_session(spark, tmp_path):
    """One on-time finding a micro-batch, minutes behind the newest: none is dropped."""
    from tests.rows import events, finding

    minute = 60_000
    order = [(0, INJECTION), (10 * minute, LOOP), (10 * minute + 1_000, LOOP), (6 * minute, INJECTION),
             (6 * minute + 1, INJECTION), (10 * minute + 2_000, LOOP)]
    for i, (t, name) in enumerate(order):
        events(spark, [finding(i, t, name, 0.95)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = jobs.start_session_incidents(source, lambda: None, f"{tmp_path}/out", Settings(emit_updates=True))
    query.awaitTermination()
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 0
    rows = spark.read.parquet(f"{tmp_path}/out/incidents").collect()
    assert {r.ruleName for r in rows} >= {"PROMPT_INJECTION_BURST"}
    assert max(r.triggeredFindingsCount for r in rows) == 6


def test_old_partition_still_counts(spark, tmp_path):
    """Windows of a partition that lags by hours are summed like all others."""
    from tests.rows import events, finding

    hour = 3_600_000
    parts = [[finding(i, 5 * hour + i * 1_000, INJECTION, 0.9) for i in range(10)], [finding(20 + i, i * 1_000, INJECTION, 0.8) for i in range(10)],
             [finding(40 + i, 5 * hour + i * 1_000, INJECTION, 0.7) for i in range(10)]]
    for part in parts:
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    whole = spark.read.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    settings = Settings()
    jobs.start_aggregates(source, f"{tmp_path}/out", settings).awaitTermination()
    got = aggregates.latest_aggregates(spark.read.parquet(f"{tmp_path}/out/aggregates").select(*aggregates.AGGREGATE_FIELDS))
    want = aggregates.aggregate_value_counts(aggregates.value_counts(whole, 60_000), settings.window_sizes_ms)
    rounded = lambda df: df.withColumn("avgConfidence", F.round("avgConfidence", 9))
    assert same(rounded(got), rounded(want)) == 4


def test_readers_see_whole_batches_only(spark, tmp_path):
    from railwatch.sources.streams import commit_sinks, committed, read_committed

    out, frame = str(tmp_path), spark.range(3)
    read = lambda name: read_committed(spark, out, "job", name, frame.schema)
    assert committed(spark, out, "job") == [] and read("one").collect() == []
    commit_sinks(spark, out, "job", 0, {"one": frame, "two": frame})
    bad = frame.select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        commit_sinks(spark, out, "job", 1, {"one": frame, "two": bad})
    assert committed(spark, out, "job") == [0] and read("one").count() == read("two").count() == 3
    # The repeated batch replaces what the broken attempt left.
    commit_sinks(spark, out, "job", 1, {"one": frame.limit(1), "two": frame})
    assert sorted((r.id, r.batch_id) for r in read("one").collect()) == [(0, 0), (0, 1), (1, 0), (2, 0)]


def test_quality_rows_follow_the_aggregates(spark, streamed, tmp_path):
    pipeline, out = streamed
    jobs.start_aggregates(stream(spark, pipeline, out), f"{tmp_path}/out", pipeline.settings, emitted_at=lambda: 5_000_000_000_000).awaitTermination()
    quality = spark.read.parquet(f"{tmp_path}/out/quality")
    assert quality.count() == spark.read.parquet(f"{tmp_path}/out/aggregates").count()
    last = aggregates.latest_rows(quality, "batch_id").drop("batch_id")
    want = aggregates.quality_metrics(aggregates.with_emit_latency(pipeline.aggregates, 5_000_000_000_000))
    rounded = lambda df: df.withColumn("avgDetectorLatencyMs", F.round("avgDetectorLatencyMs", 9))
    assert same(rounded(last), rounded(want)) > 500


def test_all_incidents_are_one_output(spark, streamed, tmp_path):
    pipeline, out = streamed
    settings, folder = Settings(), f"{tmp_path}/out"
    source = ordered_stream(spark, pipeline, out)
    assert jobs.incident_messages(spark, folder).collect() == []
    jobs.start_session_incidents(source, lambda: pipeline.timeline, folder, settings).awaitTermination()
    jobs.start_campaigns(source, folder, settings).awaitTermination()
    ids = jobs.incident_messages(spark, folder).select(F.get_json_object("value", "$.incidentId").alias("id"))
    plain = Pipeline(spark, SF, settings)
    assert same(ids, plain.all_incidents().select(F.col("incidentId").alias("id"))) > 20


def test_request_findings_as_a_stream(spark, streamed, tmp_path):
    from railwatch.operators.correlation import request_findings

    pipeline, out = streamed
    jobs.start_request_findings(stream(spark, pipeline, out), f"{tmp_path}/out", before_ms=60_000, after_ms=300_000).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/request_findings").drop("batch_id")
    assert same(got, request_findings(pipeline.events, 60_000, 300_000)) > 20


def test_scratch_of_a_stream_is_removed(spark, streamed):
    from railwatch.sources.staging import new_path

    folder = new_path(spark, "x").rsplit("/", 1)[0]
    import os

    names = os.listdir(folder)
    assert not [n for n in names if n.startswith(("intake-", "emitted-", "aggregates-"))]


def test_affected_sessions_as_mergeable_sketches(spark, tmp_path):
    """Exact for some hundred sessions, within a few per cent for many, whatever the micro-batches."""
    from tests.rows import events, finding

    rows = [finding(i, i % 250_000, confidence=0.9, triggered=i % 3 > 0, sessionId=f"s{i * 7 % 90}", agentId="few") for i in range(600)]
    rows += [finding(1_000 + i, i, confidence=0.9, sessionId=f"m{i % 3_000}", agentId="many") for i in range(6_000)]
    rows += [finding(9_000, 0, confidence=0.1, triggered=False, agentId="none")]
    for k in range(3):
        events(spark, rows[k::3]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    jobs.start_affected_sessions(source, f"{tmp_path}/out", 600_000).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/affected_sessions")
    assert got.select("batch_id").distinct().count() == 3
    last = {r.agentId: r.n for r in got.groupBy("agentId").agg(F.max_by("affectedSessions", "batch_id").alias("n")).collect()}
    exact = len({r["sessionId"] for r in rows if r["agentId"] == "few" and r["triggered"]})
    assert last["few"] == exact and last["none"] == 0 and abs(last["many"] - 3_000) < 150


def test_pieces_of_a_stream_are_written_by_many_tasks(spark):
    """Each micro-batch is one range of the rows in order, and no task writes or reads a whole piece."""
    from types import SimpleNamespace

    from railwatch.plans.catalog import _stream_pieces

    rows, seen = spark.range(0, 8_000, numPartitions=8).withColumn("v", F.lit("x")), []

    def start(source, out):
        def handle(batch, batch_id):
            a = batch.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).first()
            files = batch.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
            seen.append((a.n, a.low, a.high, files))

        return source.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()

    _stream_pieces(SimpleNamespace(spark=spark), rows, "id", start)
    assert [s[:3] for s in seen] == [(2_000, 2_000 * i, 2_000 * i + 1_999) for i in range(4)]
    assert max(s[3] for s in seen) <= 1_000


def test_the_columns_of_a_stream_need_no_batch_run(spark, monkeypatch):
    """The stream of normalised events takes its schema from the plan; the batch intake is not run beside the stream's own."""
    from railwatch.plans import catalog

    types = lambda schema: [(f.name, f.dataType) for f in schema]
    assert types(Pipeline(spark, SF).events.schema) == types(Pipeline(spark, SF).events_schema)
    monkeypatch.setattr("railwatch.plans.pipeline.staged_once", lambda *_: pytest.fail("a batch step was run"))
    out = f"{new_path(spark, 'schema')}"
    spark.range(0).write.parquet(f"{out}/normalized")
    assert "event_time" in catalog._normalized_stream(Pipeline(spark, SF), out).columns


class _Kept:
    """Value state of one key."""

    def __init__(self):
        self.value = None

    def getValueState(self, *_):  # noqa: N802
        return self

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


def _session_rows(processor, rows):
    frames = processor.handleInputRows(("a", "s"), iter([pd.DataFrame(rows)]), None)
    return [row for frame in frames for row in frame.to_dict("records")]


def _row(t, seq, name="PROMPT_INJECTION", confidence=0.5):
    return {"t": t, "seq": seq, "tenantId": "x", "requestId": f"r{seq}", "guardrailName": name, "guardrailVersion": "v",
            "policyVersion": "p", "confidence": confidence}


def test_a_dense_session_costs_the_same_per_row():
    """20,000 injections inside the look-back: each row was compared with all before it."""
    processor = SessionProcessor(Settings())
    processor.init(_Kept())
    start = time.process_time()
    found = _session_rows(processor, [_row(i * 10, i, confidence=i % 97 / 100) for i in range(20_000)] + [_row(199_999, 20_000, "TOXICITY")])
    assert time.process_time() - start < 15
    assert [(r["ruleName"], r["win_pi"], r["winmax_pi"]) for r in found] == [("PROMPT_INJECTION_BURST", 3, 0.02), ("PI_AND_TOXIC", 20_000, 0.96)]
    assert len(found[1]["requestIds"]) == 20_001


def test_the_look_back_counts_rows_in_any_order():
    rng = random.Random(3)
    recent, plain, newest = Recent({}), {}, 0
    for _ in range(3_000):
        newest = max(newest, newest + rng.randrange(-3, 4))
        at, top = newest - rng.choice((0, 0, 0, 1, 5, 9)), rng.randrange(100) / 100
        count, most = plain.get(at, (0, -1.0))
        plain[at] = (count + 1, max(most, top))
        recent.add(at, top)
        plain = {a: v for a, v in plain.items() if a >= newest - 20}
        recent.expire(newest - 20)
        for high in (newest, at):
            fits = [v for a, v in plain.items() if high - 20 <= a <= high]
            assert recent.between(high - 20, high) == (sum(c for c, _ in fits), max((m for _, m in fits), default=-1.0))
        if rng.random() < 0.05:
            recent = Recent(json.loads(json.dumps(recent.saved())))


def test_sessions_are_a_table_that_a_micro_batch_goes_on_from(spark, tmp_path, monkeypatch):
    """No call per key: Spark keeps no state for the stream, and the table gives what the rules give with keyed state."""
    from tests.rows import events, finding

    monkeypatch.setattr("railwatch.streaming.state.HELD", 2_000)
    rng, parts, settings = random.Random(5), [], Settings(emit_updates=True)
    names = [INJECTION, "TOXICITY", LOOP, "SYSTEM_PROMPT_LEAKAGE", INJECTION]
    for k in range(3):
        rows = [finding(1_000 * k + i, k * 2_400_000 + rng.randrange(2_000_000), rng.choice(names), rng.choice([0.2, 0.9, 0.9]),
                        sessionId=f"s{rng.randrange(40)}", agentId=rng.choice(["a", "b"]), requestId=f"r{rng.randrange(90)}")
                for i in range(400)]
        # Only the first micro-batch has this session: its state is handed on as it is.
        rows += [finding(900 + i, i, INJECTION, 0.9, sessionId="once") for i in range(2)] * (k == 0)
        parts.append(rows)
        events(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = jobs.start_session_incidents(source, lambda: None, f"{tmp_path}/out", settings)
    query.awaitTermination()
    assert len(query.recentProgress) == 3 and not any(p.stateOperators for p in query.recentProgress)

    kept, want = {}, []
    for rows in parts:
        groups = {}
        for r in rows:
            if r["triggered"]:
                groups.setdefault((r["agentId"], r["sessionId"]), []).append({**r, "t": r["eventTimeMillis"]})
        for key, found in groups.items():
            processor = SessionProcessor(settings)
            processor.init(kept.setdefault(key, _Kept()))
            for frame in processor.handleInputRows(key, iter([pd.DataFrame(found)]), None):
                want += [(f"{e.agentId}|{e.sessionId}|{e.ruleName}|{e.first_t}", e.t, e.revision, e.n_all, list(e.requestIds))
                         for e in frame.itertuples()]
    got = [(r.incidentId, r.emittedAtEventTimeMillis, r.emissionRevision, r.triggeredFindingsCount, r.requestIds)
           for r in spark.read.parquet(f"{tmp_path}/out/incidents").collect()]
    assert sorted(got) == sorted(want) and len(got) > 300
    states = spark.read.parquet(f"{tmp_path}/out/session_state").where("kind = 'state'")
    assert states.select("batch_id").distinct().count() == 2  # the last and the one that it went on from
    last = {(r.agentId, r.sessionId): r.body for r in states.where("batch_id = 2").collect()}
    assert {k: json.loads(v) for k, v in last.items()} == {k: json.loads(v.value[0]) for k, v in kept.items()}


def test_silent_sessions_are_freed_where_the_stream_runs_on(spark):
    from railwatch.streaming.state import FOUND, SESSION, STATE, continue_sessions
    from tests.rows import events, finding

    rows = [finding(i, i * 1_000, INJECTION, 0.9, sessionId=["s", "z"][i % 2]) for i in range(4)]
    found = events(spark, rows).withColumn("t", F.col("eventTimeMillis")).select(*SESSION, *FOUND)
    empty = spark.createDataFrame([], STATE)
    first = continue_sessions(found, empty, 7, Settings()).where("kind = 'state'").select(*STATE.fieldNames())
    again = continue_sessions(found.where("sessionId = 's'"), first, 9, Settings())
    assert {r.sessionId: r.updatedMillis for r in again.where("kind = 'state'").collect()} == {"s": 9, "z": 7}
    assert [r.n_pi for r in again.where("kind = 'emitted'").collect()] == [3]
    assert continue_sessions(found.limit(0), empty, 9, Settings()).count() == 0
