"""Online clusters of one key: the small state that a worker keeps between rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from railwatch.settings import CampaignSettings

_CLOSE = 1e-5  # below this margin a decision is taken again in single precision, in order


def ordered_dot(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Dot products as a left-to-right single-precision sum."""
    products = np.asarray(rows, dtype=np.float32) * np.asarray(vector, dtype=np.float32)
    return np.cumsum(products, axis=-1, dtype=np.float32)[..., -1]


def moved_centroid(centroid: np.ndarray, weight: int, vector: np.ndarray) -> np.ndarray:
    """Mean of ``weight`` members and one more, scaled to length one."""
    mean = (centroid * np.float32(weight) + vector) / np.float32(weight + 1)
    norm = np.float32(np.sqrt(ordered_dot(mean, mean)))
    if norm == 0:
        raise ValueError("zero centroid")
    return mean / norm


@dataclass
class Cluster:
    cluster_id: str
    centroid: np.ndarray
    first: int
    last: int
    requests: dict[str, None] = field(default_factory=dict)
    sessions: dict[str, None] = field(default_factory=dict)
    samples: dict[str, None] = field(default_factory=dict)
    revision: int = 0
    number: int = 0  # of the clusters that a book opened


class ClusterBook:
    """Active clusters of a key, in id order; bounded by the settings whatever the input.

    With ``changes`` each member that a cluster gains is given out with what it adds to the lists of the cluster, so that
    revisions need not repeat them.
    """

    def __init__(self, settings: CampaignSettings, emit_updates: bool = False, clusters=(), changes: bool = False):
        self.settings, self.emit_updates, self.changes = settings, emit_updates, changes
        self.opened = 0
        self.clusters: list[Cluster] = list(clusters)
        self.evicted = self.overflow = self.embedded = 0

    def prune(self, boundary: int) -> None:
        self.clusters = [c for c in self.clusters if c.last >= boundary]

    def _best(self, vectors: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Index of the joined cluster per row, -1 when a new one is needed."""
        limit = self.settings.similarity_threshold
        centroids = np.stack([c.centroid for c in self.clusters])
        alive = np.array([c.last for c in self.clusters]) >= (times - self.settings.window_ms)[:, None]
        scores = vectors.astype(np.float64) @ centroids.astype(np.float64).T
        scores[~alive] = -np.inf
        best = scores.argmax(axis=1)  # the first maximum has the smallest id
        top = scores[np.arange(len(best)), best]
        close = np.abs(top - limit) < _CLOSE
        if scores.shape[1] > 1:
            with np.errstate(invalid="ignore"):  # rows without an active cluster
                close |= top - np.partition(scores, -2, axis=1)[:, -2] < _CLOSE
        for row in np.flatnonzero(close & np.isfinite(top)):
            exact = np.where(alive[row], ordered_dot(centroids, vectors[row]), -np.inf)
            best[row], top[row] = exact.argmax(), exact.max()
        return np.where(top >= limit, best, -1)

    def consume(self, times, vectors, requests, sessions, snippets) -> list[tuple[int, dict]]:
        """Feed rows in time order; returns ``(row, incident values)`` for each emission.

        Rows that change nothing (known request, or a full cluster) are found for a whole
        stretch with one matrix product, so a flooded key is cheap.
        """
        if not np.isfinite(vectors).all() or vectors.shape[1] == 0:
            raise ValueError("embedding is empty or not finite")
        out, i, stretch, total = [], 0, 1, len(times)
        full = self.settings.max_requests_per_cluster
        full = float("inf") if full is None else full
        self.embedded += total
        while i < total:
            self.prune(int(times[i]) - self.settings.window_ms)
            end = min(total, i + stretch)
            target = (
                self._best(vectors[i:end], times[i:end]) if self.clusters
                else np.full(end - i, -1)
            )
            changed = False
            for j, index in zip(range(i, end), target):
                cluster = self.clusters[index] if index >= 0 else None
                if cluster is not None and requests[j] in cluster.requests:
                    continue
                if cluster is not None and len(cluster.requests) >= full:
                    self.overflow += 1
                    continue
                self.prune(int(times[j]) - self.settings.window_ms)
                emitted = self._record(cluster, int(times[j]), vectors[j], requests[j], sessions[j], snippets[j])
                if emitted is not None:
                    out.append((j, emitted))
                i, changed = j + 1, True
                break
            if changed:
                stretch = max(1, stretch // 4)
            else:
                i, stretch = end, min(4_096, stretch * 2)
        return out

    def _record(self, cluster, t, vector, request, session, snippet) -> dict | None:
        s = self.settings
        if cluster is None:
            if s.max_clusters_per_key is not None and len(self.clusters) >= s.max_clusters_per_key:
                self.clusters.remove(min(self.clusters, key=lambda c: (c.last, c.cluster_id)))
                self.evicted += 1
            cluster = Cluster(request, vector.astype(np.float32), t, t, number=self.opened)
            self.opened += 1
            self.clusters.append(cluster)
            self.clusters.sort(key=lambda c: c.cluster_id)
        cluster.requests[request] = None
        told = cluster.revision and not self.emit_updates  # nothing will list sessions and samples again
        added = []
        for known, value, limit in (
            (cluster.sessions, session, s.max_sessions_per_cluster),
            (cluster.samples, snippet[: s.max_sample_chars], s.max_samples_per_cluster),
        ):
            new = not told and value not in known and (limit is None or len(known) < limit)
            if new:
                known[value] = None
            added.append([value] if new else [])
        cluster.centroid = moved_centroid(cluster.centroid, len(cluster.requests) - 1, vector)
        cluster.first, cluster.last = min(cluster.first, t), max(cluster.last, t)
        eligible = (
            len(cluster.requests) >= s.min_unique_requests and len(cluster.sessions) >= s.min_distinct_sessions
        )
        emits = eligible and not told
        if not emits and not self.changes:
            return None
        cluster.revision += emits
        count, members = len(cluster.requests), len(cluster.sessions)
        if self.changes:
            lists = {
                "kind": "incident" if emits else "member", "cluster": cluster.number, "place": count,
                "requests": len(range(count)[: s.max_request_ids_per_incident]), "sessions": members, "samples": len(cluster.samples),
                "requestIds": [request], "sessionIds": added[0], "evidenceSnippets": added[1],
            }
        else:
            lists = {
                "requestIds": list(cluster.requests)[: s.max_request_ids_per_incident],
                "sessionIds": list(cluster.sessions), "evidenceSnippets": list(cluster.samples),
            }
        if not self.emit_updates:
            cluster.sessions, cluster.samples = {}, {}
        return {
            "incidentId": f"similar-pi|{cluster.cluster_id}", **lists,
            "firstEventTimeMillis": cluster.first,
            "lastEventTimeMillis": cluster.last,
            "emittedAtEventTimeMillis": t,
            "triggeredFindingsCount": count,
            "emissionRevision": cluster.revision,
            "summary": f"Similar prompt-injection campaign: {count} attacks across {members} sessions",
        }
