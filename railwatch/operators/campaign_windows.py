"""Campaigns of similar prompt injections in tumbling windows, over all agents or for each.

Equal texts of a scope become one row before anything is embedded.  Texts fall into cells of random
projections; the cells whose texts are seen in most sessions name the seeds of a scope, at most ``top_k_seeds``.
Every text is compared with those few seeds only, so no pairs of texts are formed, and the seeds are
copied to salted parts of a scope, so no task holds a scope.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.functions.embedding import hash_embedding, list_array
from railwatch.functions.scalars import cosine, window_start
from railwatch.operators.intake import evidence_bearing
from railwatch.schemas import PROMPT_INJECTION
from railwatch.settings import DEFAULTS, Settings
from railwatch.sources.staging import staged

SALTS = 32
STEP = 1024  # vectors that a worker widens to double precision at a time
_PRIME, _FACTOR = 2_147_483_647, 48_271


def projections(rows: int, dimension: int) -> np.ndarray:
    """Whole numbers from -1000 to 1000, a fixed function of row and column."""
    number = np.arange(1, rows * dimension + 1, dtype=np.int64) * _FACTOR % _PRIME
    return (number * number % _PRIME % 2001 - 1000).reshape(rows, dimension).astype(np.float64)


def _cells(tables: int, signs: int) -> Callable[[Column], Column]:
    """One number a table: the signs of the projections, the first one lowest."""

    @F.arrow_udf("array<int>")
    def cells(vectors: pa.Array) -> pa.Array:
        codes = np.empty((len(vectors), tables), np.int32)
        for start in range(0, len(vectors), STEP):
            part = vectors.slice(start, STEP)
            if part.null_count or len(part.value_lengths().unique()) > 1:
                raise ValueError("vectors must be there and of one size")
            matrix = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1).astype(np.float64)
            # Rounded, so that a product of zero has one sign whatever the order of its sum.
            over = np.round(matrix @ projections(tables * signs, matrix.shape[1]).T, 4) >= 0
            codes[start:start + STEP] = (over.reshape(len(matrix), tables, signs) * (1 << np.arange(signs))).sum(axis=2)
        return list_array(codes)

    return cells


def scope_columns(settings: Settings) -> list[str]:
    return ["windowStartMillis"] + (["agentId"] if settings.campaign_windows.mode == "PER_AGENT" else [])


def _salted(rows: DataFrame, few: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """Join with a side that is small in every key, which is copied to ``SALTS`` parts of the key."""
    copied = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(copied, [*keys, "__salt"]).drop("__salt")


def campaign_groups(
    events: DataFrame, settings: Settings = DEFAULTS, embedder: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Measures of the groups of all seeds, and their members as rows.

    A seed is the text of a cell that was seen in most sessions (then the earliest); cells
    rank by the sum of the sessions of their texts, and the seeds of a scope by their best cell, then by
    first appearance.  A seed's group are all findings of the scope whose text is within ``max_cosine_distance`` of it.
    """
    limits = settings.campaign_windows
    scope = scope_columns(settings)
    embed = embedder or hash_embedding(settings.campaigns)
    found = staged(evidence_bearing(events, PROMPT_INJECTION).select(
        window_start(F.col("eventTimeMillis"), limits.window_ms).alias("windowStartMillis"), "agentId", "sessionId", "requestId", "userId",
        "eventTimeMillis", "seq", "confidence", F.regexp_replace("evidenceSnippet", r"^[\x00-\x20]+|[\x00-\x20]+$", "").alias("text"),
    ), "campaign-findings")
    per_session = found.groupBy(*scope, "text", "sessionId").agg(F.min(F.struct("eventTimeMillis", "seq", "requestId")).alias("first"))
    texts = staged(
        per_session.groupBy(*scope, "text").agg(F.count(F.lit(1)).alias("sessions"), F.min("first").alias("first"))
        .withColumn("vector", embed(F.col("text"))), "campaign-texts",
    )
    place = F.struct(
        (-F.col("sessions")).alias("less"), F.col("first.eventTimeMillis").alias("at"), F.col("first.seq").alias("seq"),
    )
    celled = texts.select(*scope, "sessions", place.alias("place"), F.posexplode(_cells(limits.tables, limits.signs)(F.col("vector"))).alias("table", "cell"))
    cells = celled.groupBy(*scope, "table", "cell").agg(F.sum("sessions").alias("weight"), F.min("place").alias("place"))
    named = cells.groupBy(*scope, F.col("place.seq").alias("seedSeq")).agg(F.max("weight").alias("weight"), F.min("place.at").alias("at"))
    order = F.struct((-F.col("weight")).alias("less"), "at", "seedSeq")
    ranked = named.groupBy(*scope).agg(_smallest(order, limits.top_k_seeds).alias("best")).select(
        *scope, F.posexplode("best").alias("seed", "place")).select(*scope, "seed", F.col("place.seedSeq").alias("seedSeq"))
    keyed = texts.withColumn("seedSeq", F.col("first.seq"))
    seeds = ranked.join(keyed, [*scope, "seedSeq"]).select(
        *scope, "seed", F.col("vector").alias("seedVector"), F.col("text").alias("seedText"), F.col("first.requestId").alias("seedRequest"),
    )
    near = _salted(texts.select(*scope, "text", "vector"), seeds, scope, F.xxhash64("text")).withColumn(
        "similarity", F.round(cosine(F.col("vector"), F.col("seedVector")), 6)
    ).where(F.col("similarity") >= round(1 - limits.max_cosine_distance, 6)).select(*scope, "seed", "text", "similarity", "seedText", "seedRequest")
    members = staged(
        _salted(found, near.drop("seedText", "seedRequest"), [*scope, "text"], F.col("seq")), "campaign-members"
    )
    sizes = members.groupBy(*scope, "seed").agg(
        F.count_distinct("sessionId").alias("uniqueSessionCount"), F.count_distinct("requestId").alias("groupSize"),
        F.count_distinct("agentId").alias("agents"), F.count(F.lit(1)).alias("findings"),
        F.min("eventTimeMillis").alias("firstEventTimeMillis"), F.max("eventTimeMillis").alias("lastEventTimeMillis"),
    )
    return sizes.join(seeds.select(*scope, "seed", "seedText", "seedRequest"), [*scope, "seed"]), members


def _smallest(value: Column, k: int) -> Column:
    """The ``k`` smallest values in order.  A scope has one value a cell at most, so the set is bounded by their number."""
    return F.slice(F.array_sort(F.collect_set(value)), 1, k)


def campaign_windows(groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One incident at most a scope: the group with most sessions, then most requests, then the first seed.

    Only groups of ``min_group_size`` sessions count.  Severity goes by the number of requests.
    """
    limits = settings.campaign_windows
    scope = scope_columns(settings)
    ready = groups.where(F.col("uniqueSessionCount") >= limits.min_group_size)
    best = ready.groupBy(*scope).agg(F.max(F.struct(
        "uniqueSessionCount", "groupSize", (-F.col("seed")).alias("rank"), "agents", "findings", "firstEventTimeMillis", "lastEventTimeMillis", "seedText", "seedRequest",
    )).alias("b"))
    severity = F
    for name, least in sorted(limits.severity_by_group_size, key=lambda band: -band[1]):
        severity = severity.when(F.col("b.groupSize") >= least, name)
    size, sessions = F.col("b.groupSize"), F.col("b.uniqueSessionCount")
    return best.select(
        F.lit("PROMPT_INJECTION_CAMPAIGN").alias("incidentType"), F.lit(limits.mode).alias("detectionMode"), *scope,
        (F.col("windowStartMillis") + limits.window_ms).alias("windowEndMillis"), size.alias("groupSize"), sessions.alias("uniqueSessionCount"),
        F.col("b.agents").alias("agents"), F.col("b.findings").alias("findings"), severity.otherwise(None).alias("severity"),
        F.col("b.firstEventTimeMillis").alias("firstEventTimeMillis"), F.col("b.lastEventTimeMillis").alias("lastEventTimeMillis"),
        F.col("b.seedRequest").alias("representativeRequestId"), F.col("b.seedText").alias("representativeRequest"),
        F.concat(size.cast("string"), F.lit(" similar prompt injections from "), sessions.cast("string"), F.lit(" sessions")).alias("explanation"),
        (-F.col("b.rank")).cast("int").alias("seed"),
    )


def campaign_members(incidents: DataFrame, members: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The findings of every incident, one row each; incidents name no lists, so none grows."""
    scope = scope_columns(settings)
    chosen = _salted(members, incidents.select(*scope, "seed"), [*scope, "seed"], F.col("seq"))
    return chosen.select(
        "windowStartMillis", "agentId", "sessionId", "requestId", "userId", "eventTimeMillis", "seq", "confidence", "similarity",
    )
