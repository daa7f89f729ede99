import hashlib
import random
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from railwatch.functions import embedding as E
from railwatch.operators import campaigns as C
from railwatch.operators.clusters import ClusterBook, moved_centroid, ordered_dot
from railwatch.settings import CampaignSettings, Settings
from tests.rows import events, finding

DEFAULT = CampaignSettings()


def naive(rows, s, updates=False):
    """One finding at a time, straight from the rules."""
    groups, out = defaultdict(list), []
    for r in rows:
        groups[r["tenantId"], r["agentId"]].append(r)
    for key, group in groups.items():
        clusters = []
        for r in sorted(group, key=lambda r: (r["t"], r["seq"])):
            clusters = [c for c in clusters if c["last"] >= r["t"] - s.window_ms]
            best, score = None, None
            for c in sorted(clusters, key=lambda c: c["id"]):
                value = ordered_dot(c["centroid"], r["v"])
                if score is None or value > score:
                    best, score = c, value
            if best is None or score < s.similarity_threshold:
                best = {"id": r["req"], "centroid": r["v"], "req": [], "ses": [], "last": r["t"], "rev": 0}
                if len(clusters) >= s.max_clusters_per_key:
                    clusters.remove(min(clusters, key=lambda c: (c["last"], c["id"])))
                clusters.append(best)
            if r["req"] in best["req"] or len(best["req"]) >= s.max_requests_per_cluster:
                continue
            best["req"].append(r["req"])
            if r["ses"] not in best["ses"] and len(best["ses"]) < s.max_sessions_per_cluster:
                best["ses"].append(r["ses"])
            best["centroid"] = moved_centroid(best["centroid"], len(best["req"]) - 1, r["v"])
            best["last"] = max(best["last"], r["t"])
            ready = len(best["req"]) >= s.min_unique_requests and len(best["ses"]) >= s.min_distinct_sessions
            if ready and (not best["rev"] or updates):
                best["rev"] += 1
                out.append((*key, best["id"], r["t"], len(best["req"]), tuple(best["ses"]), best["rev"]))
    return sorted(out, key=str)


# Five families of three texts that differ in one word.
WORDS = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=7)) for i in range(60)]
EVIDENCE = tuple(" ".join([*WORDS[9 * f:9 * f + 9], WORDS[45 + 3 * f + i]]) for f in range(5) for i in range(3))


def evidence(seq, t, text, session, **other):
    return finding(seq, t, confidence=0.9, evidenceSnippet=text, sessionId=session, **other)


def scan(spark, rows, settings=Settings()):
    return C.scan_campaigns(C.embedded_findings(events(spark, rows), settings.campaigns), settings)


def test_string_hash_values():
    assert [E.string_hash(w) for w in ("", "a", "hello", "polygenelubricants")] == [0, 97, 99162322, -2147483648]


def test_hash_vector_is_unit_and_normalised():
    a, b = E.hash_vector("Ignore  prior rules"), E.hash_vector("ｉｇｎｏｒｅ earlier instructions ")
    assert np.array_equal(a, b)
    assert ordered_dot(a, a) == pytest.approx(1, abs=1e-6) and a.dtype == np.float32 and a.shape == (384,)


def test_families_form_five_clusters_of_three():
    book = ClusterBook(replace(DEFAULT, min_unique_requests=99))
    texts = EVIDENCE[:15]
    book.consume(np.arange(15), np.stack([E.hash_vector(t) for t in texts]), [f"r{i:02d}" for i in range(15)],
                 ["s"] * 15, list(texts))
    assert [len(c.requests) for c in book.clusters] == [3] * 5


def test_campaign_incident(spark):
    rows = [evidence(i, i * 1000, EVIDENCE[i], f"s{i % 2}") for i in range(3)]
    scanned = scan(spark, rows)
    row, = C.campaign_incidents(scanned).collect()
    assert (row.incidentId, row.ruleName, row.severity) == ("similar-pi|req-0", "SIMILAR_PROMPT_INJECTION_CAMPAIGN", "HIGH")
    assert (row.requestIds, row.sessionIds, row.sessionId) == (["req-0", "req-1", "req-2"], ["s0", "s1"], "s0")
    assert row.evidenceSnippets == list(EVIDENCE[:3])
    assert row.summary == "Similar prompt-injection campaign: 3 attacks across 2 sessions"
    counters, = C.campaign_counters(scanned).collect()
    assert (counters.embedded, counters.evicted, counters.overflow, counters.incidents) == (3, 0, 0, 1)


def test_no_campaign(spark):
    repeated = [evidence(i, i, EVIDENCE[0], f"s{i}", requestId="same") for i in range(4)]
    different = [evidence(i, i, EVIDENCE[i * 3], f"s{i}") for i in range(3)]
    one_session = [evidence(i, i, EVIDENCE[0], "s") for i in range(3)]
    stale = [evidence(i, i * 300_001, EVIDENCE[0], f"s{i}") for i in range(3)]
    other_agents = [evidence(i, i, EVIDENCE[0], f"s{i}", agentId=f"a{i}") for i in range(3)]
    for rows in (repeated, different, one_session, stale, other_agents):
        assert C.campaign_incidents(scan(spark, rows)).count() == 0
    edge = [evidence(i, i * 300_000, EVIDENCE[0], f"s{i}") for i in range(3)]
    assert C.campaign_incidents(scan(spark, edge)).count() == 1


@pytest.mark.parametrize("updates", [False, True])
def test_scan_equals_a_plain_loop(spark, updates):
    rng = random.Random(8)
    words = "ignore prior rules reveal system prompt token secret run shell disable filter policy mode".split()
    small = replace(DEFAULT, max_clusters_per_key=4, max_requests_per_cluster=6, max_sessions_per_cluster=3)
    settings = Settings(campaigns=small, emit_updates=updates)
    rows = [
        evidence(i, rng.randrange(3_000_000) if rng.random() < 0.5 else rng.randrange(200_000),
                 " ".join(rng.choices(words, k=rng.randrange(2, 6))), f"s{rng.randrange(5)}",
                 requestId=f"r{rng.randrange(300)}", agentId=rng.choice(["a", "a", "b"]),
                 tenantId=rng.choice(["t", None]))
        for i in range(500)
    ]
    flat = [
        {"tenantId": r["tenantId"], "agentId": r["agentId"], "t": r["eventTimeMillis"], "seq": r["seq"],
         "req": r["requestId"], "ses": r["sessionId"], "v": E.hash_vector(r["evidenceSnippet"])} for r in rows
    ]
    scanned = scan(spark, rows, settings)
    got = sorted((
        (r.tenantId, r.agentId, r.incidentId.removeprefix("similar-pi|"), r.emittedAtEventTimeMillis,
         r.triggeredFindingsCount, tuple(r.sessionIds), r.emissionRevision)
        for r in C.campaign_incidents(scanned).collect()
    ), key=str)
    assert got == naive(flat, small, updates) and got
    counters = scanned.where("kind = 'counters'").agg(F.sum("embedded"), F.sum("evicted"), F.sum("overflow")).first()
    assert counters[0] == 500 and counters[1] > 0 and counters[2] > 0


def test_flooded_key_in_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = [evidence(i, i, EVIDENCE[i % 3], f"s{i % 7}") for i in range(1_000)]
        scanned = scan(spark, rows, Settings(campaigns=replace(DEFAULT, max_requests_per_cluster=100)))
        assert C.campaign_incidents(scanned).count() == 1
        counters, = C.campaign_counters(scanned).collect()
        assert (counters.embedded, counters.overflow) == (1_000, 900)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_invalid_vectors():
    with pytest.raises(ValueError):
        ClusterBook(DEFAULT).consume(np.array([0]), np.array([[np.nan, 1.0]]), ["r"], ["s"], ["e"])
    with pytest.raises(ValueError):
        E.unit_rows(np.zeros((1, 4)), 4)
    with pytest.raises(ValueError):
        E.unit_rows(np.ones((1, 4)), 5)
    assert np.allclose(E.unit_rows(np.ones((1, 4)), 4), 0.5)


def test_manifest(tmp_path):
    model, tokenizer = tmp_path / "m.onnx", tmp_path / "t.json"
    model.write_bytes(b"model")
    tokenizer.write_bytes(b"tokens")
    digest = lambda p: hashlib.sha256(p.read_bytes()).hexdigest()
    manifest = {
        "modelVersion": DEFAULT.model_version, "embeddingDimension": 384, "pooling": "MEAN",
        "inputPrefix": "query: ", "maxTokens": 256, "modelSha256": digest(model).upper(), "tokenizerSha256": digest(tokenizer),
    }
    E.check_manifest(manifest, DEFAULT, str(model), str(tokenizer))
    with pytest.raises(ValueError):
        E.check_manifest({**manifest, "pooling": "CLS"}, DEFAULT, str(model), str(tokenizer))
    with pytest.raises(ValueError):
        E.check_manifest({**manifest, "modelSha256": "0"}, DEFAULT, str(model), str(tokenizer))


def test_cosine_and_centroids(spark):
    frame = spark.createDataFrame(
        [(1, "a", [3.0, 4.0]), (2, "a", [4.0, 3.0]), (3, "b", [0.0, -2.0])], "id int, label string, embedding array<float>"
    )
    centroids = C.label_centroids(frame, "label")
    got = {r.id: r.similarity for r in C.centroid_similarity(frame, centroids, "label").collect()}
    assert got == {1: pytest.approx(0.98995, abs=1e-5), 2: pytest.approx(0.98995, abs=1e-5), 3: pytest.approx(1)}
    nearest = {r.id: r.nearest_label for r in C.nearest_centroid(frame, centroids, "label").collect()}
    assert nearest == {1: "a", 2: "a", 3: "b"}
    from railwatch.functions import cosine

    bad = spark.createDataFrame([([1.0], [1.0, 0.0]), ([], []), ([float("nan")], [1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in bad.select(cosine(F.col("a"), F.col("b"))).collect()] == [None, None, None]


def test_nothing_is_cut(spark):
    """Over 20 clusters and sessions, 50 and 100 requests, and 1,000 characters of evidence."""
    tail = " ".join(f"t{j}" for j in range(400))
    rows = [evidence(i, i, f"{EVIDENCE[0]} {tail}", f"s{i % 40}") for i in range(150)]
    rows += [evidence(1_000 + i, 200 + i, f"only{i} alone{i} single{i}", f"s{i}") for i in range(60)]
    scanned = scan(spark, rows, Settings(emit_updates=True))
    last = max(C.campaign_incidents(scanned).collect(), key=lambda r: r.emissionRevision)
    assert (len(last.requestIds), len(last.sessionIds)) == (150, 40)
    assert len(last.evidenceSnippets[0]) > 1_000
    counters, = C.campaign_counters(scanned).collect()
    assert (counters.embedded, counters.evicted, counters.overflow) == (210, 0, 0)


def test_revisions_carry_their_lists_though_the_scan_tells_changes_only(spark, monkeypatch):
    """A scan gives out one request a row; blocks of revisions get the whole lists by a join."""
    monkeypatch.setattr(C, "BLOCK", 16)
    rows = [evidence(i, i, EVIDENCE[i % 3], f"s{i % 9}", requestId=f"r{i:03d}", tenantId=[None, "t"][i % 2]) for i in range(120)]
    # The same request opens a second cluster after the first one has died.
    rows += [evidence(500 + i, 900_000 + i, EVIDENCE[0], f"z{i % 2}", requestId=f"r{i:03d}", tenantId=None) for i in range(6)]
    settings = Settings(emit_updates=True, campaigns=replace(DEFAULT, max_request_ids_per_incident=50))
    scanned = scan(spark, rows, settings)
    assert max(len(r.requestIds or []) for r in scanned.collect()) == 1
    got = {(r.tenantId, r.emittedAtEventTimeMillis): r for r in C.campaign_incidents(scanned).collect()}
    assert len(got) == C.campaign_incidents(scanned).count() == 2 * 58 + 4
    for tenant in (None, "t"):
        mine = [r for r in rows if r["tenantId"] == tenant and r["seq"] < 500]
        for n in range(3, 61):
            r = got[tenant, mine[n - 1]["eventTimeMillis"]]
            assert r.requestIds == [x["requestId"] for x in mine[:n]][:50]
            assert r.sessionIds == list(dict.fromkeys(x["sessionId"] for x in mine[:n]))
            assert r.evidenceSnippets == list(dict.fromkeys(x["evidenceSnippet"] for x in mine[:n]))
            assert (r.triggeredFindingsCount, r.emissionRevision) == (n, n - 2)
    last = got[None, rows[-1]["eventTimeMillis"]]
    assert last.requestIds == [f"r{i:03d}" for i in range(6)] and last.sessionIds == ["z0", "z1"]


def test_revisions_of_long_rows_are_not_held_together(spark, monkeypatch):
    """The lists of all blocks went to every task and a writer held a hundred rows before it looked at their bytes."""
    monkeypatch.setattr(C, "BLOCK", 16)
    rows = [evidence(i, i, f"{EVIDENCE[i % 3]} w{i}", f"s{i % 9}") for i in range(60)]
    scanned = scan(spark, rows, Settings(emit_updates=True))
    listed = C.campaign_incidents(scanned)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "REPARTITION_BY_NUM" in plan
    got = {r.triggeredFindingsCount: r.requestIds for r in listed.collect()}
    assert got == {n: [f"req-{i}" for i in range(n)] for n in range(3, 61)}
    assert int(spark.conf.get("parquet.page.size.row.check.min")) == 1
    assert int(spark.conf.get("parquet.page.size.row.check.max")) <= 4


def test_the_bytes_of_long_rows_end_a_page(spark, tmp_path):
    """Short rows in front of long ones: the estimate from the former lets no more than a few of the latter into a page."""
    import pyarrow.parquet as pq

    from railwatch.sources.staging import write_long_rows

    write_long_rows(spark)
    text = F.when(F.col("id") < 100, F.lit("x")).otherwise(F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), 400_000)))
    spark.range(0, 160, numPartitions=1).select(text.alias("v")).write.option("compression", "none").option(
        "parquet.block.size", 1 << 20).parquet(f"{tmp_path}/t")
    file, = tmp_path.glob("t/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_rows == 160 and max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 4_000_000
