"""Configuration of the analytics jobs.

One frozen dataclass holds every tunable.  Durations are milliseconds unless the name
says otherwise; the defaults are the contract values that results are compared at.
"""

from __future__ import annotations

from dataclasses import dataclass

MINUTE_MS = 60_000


@dataclass(frozen=True)
class CampaignSettings:
    """Similar-attack campaign detection."""

    enabled: bool = True
    window_ms: int = 5 * MINUTE_MS
    similarity_threshold: float = 0.5
    min_unique_requests: int = 3
    min_distinct_sessions: int = 2
    severity: str = "HIGH"
    model_version: str = "deterministic-hash-v1"
    input_prefix: str = "query: "
    dimension: int = 384
    max_tokens: int = 256
    # Limits; None keeps everything.
    max_evidence_chars: int | None = None
    max_clusters_per_key: int | None = None
    max_requests_per_cluster: int | None = None
    max_sessions_per_cluster: int | None = None
    max_samples_per_cluster: int | None = None
    max_sample_chars: int | None = None
    max_request_ids_per_incident: int | None = None


@dataclass(frozen=True)
class CampaignWindowSettings:
    """One campaign incident at most a tumbling window and scope."""

    mode: str = "GLOBAL"  # or PER_AGENT
    window_ms: int = 5 * MINUTE_MS
    min_group_size: int = 3  # distinct sessions
    top_k_seeds: int = 3
    max_cosine_distance: float = 0.12
    severity_by_group_size: tuple[tuple[str, int], ...] = (("CRITICAL", 12), ("HIGH", 8), ("MEDIUM", 5), ("LOW", 3))
    # Seeds are looked for in the cells of random projections: so many tables, so many signs a cell.
    tables: int = 6
    signs: int = 8

    def __post_init__(self) -> None:
        if self.mode not in ("GLOBAL", "PER_AGENT"):
            raise ValueError(f"unknown mode {self.mode!r}")


@dataclass(frozen=True)
class Settings:
    """Intake, windows, session rules and policies."""

    out_of_orderness_ms: int = 30_000
    late_tolerance_ms: int = 5 * MINUTE_MS
    idle_timeout_ms: int = MINUTE_MS
    checkpoint_interval_ms: int = 30_000
    watermark_interval_ms: int = 5_000
    window_type: str = "tumbling-event-time"
    window_sizes_ms: tuple[int, ...] = (MINUTE_MS, 5 * MINUTE_MS)
    delivery_guarantee: str = "AT_LEAST_ONCE"

    incidents_enabled: bool = True
    emit_updates: bool = False
    session_timeout_ms: int = 30 * MINUTE_MS
    max_request_ids: int | None = None  # of an incident; None lists all
    list_members: bool = True  # False: incidents have no lists, their members are rows of a table
    state_idle_ms: int = 24 * 60 * MINUTE_MS  # wall-clock time after which a silent key's state is freed
    injection_burst_min: int = 3
    toxicity_campaign_min: int = 3
    looping_min: int = 2
    pi_and_toxic_enabled: bool = True
    pi_and_toxic_window_ms: int = 5 * MINUTE_MS
    pi_and_toxic_severity: str = "HIGH"
    pi_and_toxic_min_injections: int = 1
    pi_and_toxic_min_toxic: int = 1
    pi_and_toxic_min_injection_confidence: float | None = None
    pi_and_toxic_min_toxicity_confidence: float | None = None

    reject_older_policies: bool = True
    campaigns: CampaignSettings = CampaignSettings()
    campaign_windows: CampaignWindowSettings = CampaignWindowSettings()

    def __post_init__(self) -> None:
        if self.pi_and_toxic_window_ms > self.session_timeout_ms:
            # Session scans cut time into blocks of this width; a block must never be
            # able to hide an inactivity gap.
            raise ValueError("pi_and_toxic_window_ms must not exceed session_timeout_ms")
        if self.delivery_guarantee not in ("NONE", "AT_LEAST_ONCE"):
            raise ValueError(f"unknown delivery guarantee {self.delivery_guarantee!r}")
        if not self.window_sizes_ms or min(self.window_sizes_ms) <= 0:
            raise ValueError("window sizes must be positive")


DEFAULTS = Settings()
