"""Cross-session campaigns of similar prompt-injection evidence.

Clustering a key is sequential by definition: each finding is compared with centroids that
all earlier ones moved.  What Spark can spread, it spreads: texts are embedded before the
shuffle, and a key is cut wherever it was idle longer than the window, since no cluster
survives that.  The ordered scan of a piece reads Arrow batches; its memory is the clusters that
are alive, which the settings can limit.  Where every revision is given out, the scan tells what each member adds to its
cluster, and a join puts the lists of the revisions together, spread over blocks of revisions.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.functions.embedding import hash_embedding
from railwatch.functions.scalars import cosine_to_unit, unit
from railwatch.operators.clusters import ClusterBook
from railwatch.operators.intake import evidence_bearing
from railwatch.schemas import INCIDENT, INCIDENT_FIELDS, PROMPT_INJECTION, SIMILAR_RULE
from railwatch.settings import DEFAULTS, CampaignSettings, Settings
from railwatch.sources.staging import staged, write_long_rows

CAMPAIGN_KEY = ["tenantId", "agentId", "guardrailName", "embeddingModelVersion"]
NO_VALUE = "\u0000"
COUNTERS = ("embedded", "evicted", "overflow")
# Where in its key and its cluster a member is, and how much of the cluster's lists it has seen.
PLACES = ("piece", "cluster", "place", "requests", "sessions", "samples")
BLOCK = 1024  # revisions that get their lists in one task
LISTED_ROWS = 256  # rows between two outputs of a scan whose incidents carry lists

SCANNED = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("guardrailName", T.StringType())]
    + list(INCIDENT.fields)
    + [T.StructField(c, T.LongType()) for c in COUNTERS]
)
CHANGES = T.StructType([*SCANNED.fields, *[T.StructField(c, T.LongType()) for c in PLACES]])
STATE = T.StructType(
    [T.StructField(c, T.StringType()) for c in CAMPAIGN_KEY]
    + [T.StructField("body", T.BinaryType()), T.StructField("updatedMillis", T.LongType())]
)
CONTINUED = T.StructType([*SCANNED.fields, *STATE.fields[-2:]])


def embedded_findings(
    events: DataFrame, settings: CampaignSettings = DEFAULTS.campaigns,
    embedder: Callable[[Column], Column] | None = None, guardrail: str = PROMPT_INJECTION,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Evidence-bearing findings with a unit vector.  The filter runs before the embedder."""
    embed = embedder or hash_embedding(settings)
    trimmed = F.regexp_replace("evidenceSnippet", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    chosen = evidence_bearing(events, guardrail).select(
        "tenantId", "agentId", "sessionId", "requestId", "eventTimeMillis", "seq", "guardrailName",
        F.lit(settings.model_version).alias("embeddingModelVersion"),
        (trimmed if settings.max_evidence_chars is None else F.substring(trimmed, 1, settings.max_evidence_chars))
        .alias("evidenceSnippet"), *keep,
    )
    return chosen.withColumn("embedding", embed(F.col("evidenceSnippet")))


def _pieces(found: DataFrame, settings: CampaignSettings) -> DataFrame:
    """Add ``piece``: the part of a key between idle times longer than the window."""
    keyed = found.withColumns({
        "__tenant": F.coalesce(F.col("tenantId"), F.lit(NO_VALUE)),
        "__block": F.floor(F.col("eventTimeMillis") / F.lit(settings.window_ms)),
    })
    key = ["__tenant", "agentId", "guardrailName", "embeddingModelVersion"]
    # Two rows of one block are never further apart than the window, so idle times show up
    # between blocks; there is one small row per key and block.
    totals = keyed.groupBy(*key, "__block").agg(
        F.min("eventTimeMillis").alias("lo"), F.max("eventTimeMillis").alias("hi")
    )
    order = Window.partitionBy(*key).orderBy("__block")
    idle = F.col("lo") - F.lag("hi").over(order) > settings.window_ms
    numbered = totals.select(
        *key, "__block",
        F.sum(F.coalesce(idle.cast("int"), F.lit(0)))
        .over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("piece"),
    )
    return keyed.join(numbered, [*key, "__block"]).drop("__block")


def _incident_row(key: tuple, finding: tuple, values: dict, settings: CampaignSettings) -> dict:
    tenant, agent, guardrail, version = key
    return {
        "kind": "incident", "guardrailName": guardrail, "tenantId": tenant, "agentId": agent,
        "sessionId": finding[0], "ruleName": SIMILAR_RULE, "severity": settings.severity,
        "guardrailNames": [], "guardrailVersions": [], "policyVersions": [],
        "embeddingModelVersion": version, **values,
    }


def _counter_row(key: tuple, book: ClusterBook) -> dict:
    tenant, agent, guardrail, version = key
    return {
        "kind": "counters", "guardrailName": guardrail, "tenantId": tenant, "agentId": agent,
        "embeddingModelVersion": version,
        **{name: getattr(book, name) for name in COUNTERS},
    }


def scanned_frame(rows: list[dict], schema: T.StructType = SCANNED) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=schema.fieldNames())
    for field in schema.fields:
        if field.dataType.typeName() in ("integer", "long"):
            frame[field.name] = frame[field.name].astype("Int64")
    return frame.astype(object).where(frame.notna(), None)


def consume_frame(book: ClusterBook, part: pd.DataFrame, key: tuple, settings: CampaignSettings) -> list[dict]:
    """Feed the ordered rows of one key to its clusters."""
    sessions = part["sessionId"].tolist()
    emitted = book.consume(
        part["eventTimeMillis"].to_numpy(np.int64),
        np.stack(part["embedding"].to_numpy()).astype(np.float32),
        part["requestId"].tolist(), sessions, part["evidenceSnippet"].tolist(),
    )
    return [_incident_row(key, (sessions[i],), values, settings) for i, values in emitted]


def _groups(batches: Iterator[pd.DataFrame], group: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Adjacent rows of one group; a group may go on in the next batch."""
    for batch in batches:
        if not len(batch):
            continue
        marks = batch[group]
        starts = np.flatnonzero((marks != marks.shift()).any(axis=1).to_numpy())
        for start, end in zip(starts, [*starts[1:], len(batch)]):
            part = batch.iloc[start:end]
            yield tuple(part.iloc[0][group]), part


def scan_campaigns(found: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Ordered clustering scan: incident rows and, per piece, one row of counters.

    With ``emit_updates`` an incident row has only what its member adds to the lists, there are rows of kind ``member`` for those
    that emit nothing, and the scan is written as a table, since :func:`campaign_incidents` reads it twice.
    """
    campaign, updates = settings.campaigns, settings.emit_updates
    group = ["__tenant", "agentId", "guardrailName", "embeddingModelVersion", "piece"]
    columns = [*group, "sessionId", "requestId", "eventTimeMillis", "evidenceSnippet", "embedding"]
    schema = CHANGES if updates else SCANNED
    ordered = (
        _pieces(found, campaign).repartition(*group)
        .sortWithinPartitions(*group, "eventTimeMillis", "seq").select(*columns)
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, key, book = None, None, None
        for head, part in _groups(batches, group):
            rows: list[dict] = []
            if head != current:
                if book is not None:
                    rows.append(_counter_row(key, book))
                current, book = head, ClusterBook(campaign, updates, changes=updates)
                key = (None if head[0] == NO_VALUE else head[0], *head[1:4])
            rows += [{**row, "piece": head[4]} for row in consume_frame(book, part, key, campaign)]
            if rows:
                yield scanned_frame(rows, schema)
        if book is not None:
            yield scanned_frame([_counter_row(key, book)], schema)

    scanned = ordered.mapInPandas(scan, schema)
    return staged(scanned, "campaign-scan") if updates else scanned


def continue_campaigns(found: DataFrame, state: DataFrame, at_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """The scan of one micro-batch on top of the clusters of earlier ones (``STATE``): incident rows and, per key, one of kind ``state``.

    Rows of a key come sorted out of Spark's exchange behind the row of its state, and are read in Arrow batches.
    """
    campaign, updates = settings.campaigns, settings.emit_updates
    group = ["__tenant", *CAMPAIGN_KEY[1:]]
    tenant = F.coalesce(F.col("tenantId"), F.lit(NO_VALUE)).alias("__tenant")
    rows = found.select(
        tenant, *CAMPAIGN_KEY[1:], "sessionId", "requestId", "eventTimeMillis", "seq", "evidenceSnippet", "embedding")
    known = state.select(tenant, *CAMPAIGN_KEY[1:], "body", "updatedMillis")
    ordered = rows.unionByName(known, allowMissingColumns=True).repartition(*group).sortWithinPartitions(
        *group, F.col("body").isNull(), "eventTimeMillis", "seq")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, key, book, updated = None, None, None, None

        def saved() -> pd.DataFrame:
            names = dict(zip(CAMPAIGN_KEY, key))
            return scanned_frame([{"kind": "state", **names, "body": pickle.dumps(book.clusters), "updatedMillis": updated}], CONTINUED)

        for head, part in _groups(batches, group):
            if head != current:
                if book is not None:
                    yield saved()
                current, book = head, ClusterBook(campaign, updates)
                key = (None if head[0] == NO_VALUE else head[0], *head[1:])
            for body, at in zip(part["body"], part["updatedMillis"]):
                if body is None:
                    break
                book, updated = ClusterBook(campaign, updates, pickle.loads(bytes(body))), int(at)
            part = part[part["body"].isna()]
            step = LISTED_ROWS if updates else max(1, len(part))
            for start in range(0, len(part), step):
                updated = at_ms
                emitted = consume_frame(book, part.iloc[start:start + step], key, campaign)
                if emitted:
                    yield scanned_frame(emitted, CONTINUED)
        if book is not None:
            yield saved()

    return ordered.mapInPandas(scan, CONTINUED)


def campaign_incidents(scanned: DataFrame) -> DataFrame:
    return _listed(scanned).select(*INCIDENT_FIELDS)


def _listed(scanned: DataFrame) -> DataFrame:
    """Incident rows with whole lists."""
    incidents = scanned.where(F.col("kind") == "incident")
    if "place" not in scanned.columns:
        return incidents
    cluster = ["__tenant", *CAMPAIGN_KEY[1:], "piece", "cluster"]
    tenant = F.coalesce(F.col("tenantId"), F.lit(NO_VALUE))
    keyed = scanned.where(F.col("kind").isin("incident", "member")).withColumn("__tenant", tenant)
    upto = {"requestIds": "requests", "sessionIds": "sessions", "evidenceSnippets": "samples"}
    added = lambda c: F.when(F.size(c) > 0, F.struct("place", F.col(c)[0].alias("value")))
    # A block gets what its last revision lists, not what the cluster lists in the end.
    known = lambda c: F.transform(
        F.filter(f"all_{c}", lambda v: v["place"] < (F.col("block") + 1) * BLOCK), lambda v: v["value"])
    lists = keyed.groupBy(*cluster).agg(
        F.max("place").alias("top"), *[F.sort_array(F.collect_list(added(c))).alias(f"all_{c}") for c in upto]
    ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("top") / BLOCK)))).select(
        *cluster, "block", *[known(c).alias(f"all_{c}") for c in upto])
    revisions = keyed.where(F.col("kind") == "incident").withColumn("block", F.floor(F.col("place") / BLOCK))
    whole = {c: F.slice(f"all_{c}", F.lit(1), F.col(n).cast("int")) for c, n in upto.items()}
    # Rows get far longer here than any size that Spark has measured: it would send the lists of all blocks to every task, and
    # give a task many blocks. A given number of parts is left as it is.
    spark = scanned.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = lambda rows: rows.repartition(parts, *cluster, "block")
    write_long_rows(spark)
    return dealt(revisions.drop(*upto)).join(dealt(lists).hint("merge"), [*cluster, "block"]).withColumns(whole)


def campaign_counters(scanned: DataFrame) -> DataFrame:
    """Findings embedded, clusters evicted, requests beyond a full cluster, incidents."""
    return scanned.groupBy("tenantId", "agentId", "guardrailName", "embeddingModelVersion").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS],
        F.count_if(F.col("kind") == "incident").alias("incidents"),
    )


def label_centroids(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Unit mean vector per key.

    Components are averaged as rows, with partial sums on the map side, so the largest key
    costs its reducers one row per task and component.
    """
    parts = vectors.select(key, F.posexplode(vector).alias("pos", "x"))
    means = parts.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    whole = means.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m"))
    return whole.select(key, unit(F.transform("m", lambda p: p["mean"])).alias("centroid"))


def centroid_similarity(vectors: DataFrame, centroids: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Cosine of every vector with the centroid of its key."""
    return vectors.join(centroids, key).withColumn(
        "similarity", cosine_to_unit(F.col(vector), F.col("centroid"))
    )


def nearest_centroid(
    vectors: DataFrame, centroids: DataFrame, name: str, vector: str = "embedding", limit: int = 20,
) -> DataFrame:
    """Best centroid of every vector; equal cosines go to the smallest name.

    The candidates of a key are bounded by contract, so they travel as one array of at most
    ``limit`` entries; more is an error rather than a silent cut.
    """
    packed = centroids.groupBy().agg(F.sort_array(F.collect_list(F.struct(name, "centroid"))).alias("__all"))
    checked = packed.select(
        F.when(F.size("__all") <= limit, F.col("__all"))
        .otherwise(F.raise_error(F.lit(f"more than {limit} centroids"))).alias("__all")
    ).scalar()
    scored = F.transform("__all", lambda c: F.struct(
        (-F.round(cosine_to_unit(F.col(vector), c["centroid"]), 9)).alias("distance"), c[name].alias(name)
    ))
    return vectors.withColumn("__all", checked).withColumn("__best", F.array_min(scored)).select(
        *[c for c in vectors.columns if c != vector],
        F.col(f"__best.{name}").alias(f"nearest_{name}"),
        (-F.col("__best.distance")).alias("similarity"),
    )
