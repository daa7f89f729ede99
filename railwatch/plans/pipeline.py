"""The batch job over one set of tables, step by step.

Steps that several others read are staged once per application; everything else stays a
lazy DataFrame.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property, reduce
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railwatch.operators import aggregates, campaigns, incidents, intake, policies
from railwatch.schemas import INCIDENT, POLICY_SECTIONS, SESSION_RULES
from railwatch.settings import DEFAULTS, Settings
from railwatch.sources import tables
from railwatch.sources.staging import folder_state, ship_package, staged_once

# Fixed values of the derivation: the policy in force before any update.
BOOTSTRAP = {
    "version": "base-0", "updated_at": "2026-08-20T00:00:00Z",
    "defaults": dict(zip(POLICY_SECTIONS, (
        {"medium": 0.55, "high": 0.75, "critical": 0.90}, {"medium": 0.70, "high": 0.90},
        {"severity": "MEDIUM"}, {"severity": "CRITICAL"},
    ))),
    "agents": {"agent-0": {"promptInjection": {"high": 0.68, "critical": 0.93}}},
}


class Pipeline:
    """Lazily built steps over ``sf_dir``; nothing runs before a step is used."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = DEFAULTS):
        self.spark, self.sf_dir, self.settings = spark, sf_dir.rstrip("/"), settings
        ship_package(spark)

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    def _staged(self, step: str, build, *settings) -> DataFrame:
        """One table per step, per the files it was made from and the settings it depends on."""
        return staged_once(self.spark, f"{self.sf_dir}|{self._files}|{step}|{settings}", build)

    @cached_property
    def _files(self) -> str:
        return folder_state(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return tables.raw_events(self.table("events"), self.table("conversations"))

    @cached_property
    def parsed(self) -> DataFrame:
        return self._staged("parsed", lambda: intake.parse(self.raw))

    @cached_property
    def watermarked(self) -> DataFrame:
        return self._staged(
            "watermarked", lambda: intake.with_watermark(intake.valid(self.parsed), self.settings),
            self.settings.out_of_orderness_ms,
        )

    @cached_property
    def events(self) -> DataFrame:
        """Normalised on-time events."""
        return intake.on_time(self.watermarked, self.settings)

    @cached_property
    def events_schema(self) -> StructType:
        """The columns of :attr:`events`, from the plan alone: nothing is read or staged."""
        return intake.on_time(intake.with_watermark(intake.valid(intake.parse(self.raw)), self.settings), self.settings).schema

    @cached_property
    def value_counts(self) -> DataFrame:
        """Mergeable partial measures: the only pass of the aggregates over the events."""
        base = reduce(gcd, self.settings.window_sizes_ms)
        return self._staged(
            "value_counts", lambda: aggregates.value_counts(self.events, base),
            base, self.settings.out_of_orderness_ms, self.settings.late_tolerance_ms,
        )

    def window_aggregates(self, *sizes_ms: int) -> DataFrame:
        return aggregates.aggregate_value_counts(
            self.value_counts, sizes_ms or self.settings.window_sizes_ms
        )

    @cached_property
    def aggregates(self) -> DataFrame:
        return self.window_aggregates()

    @cached_property
    def bootstrap(self) -> DataFrame:
        return policies.policy_literal(self.spark, **BOOTSTRAP)

    @cached_property
    def policy_messages(self) -> DataFrame:
        return tables.policy_updates(self.table("supplier"))

    @cached_property
    def parsed_policies(self) -> DataFrame:
        return self._staged("policies", lambda: policies.parse_policies(self.policy_messages))

    @cached_property
    def decided(self) -> DataFrame:
        return self._staged("decided", lambda: policies.decide(
            self.bootstrap.unionByName(self.parsed_policies), self.settings
        ), self.settings.reject_older_policies)

    @cached_property
    def topic_timeline(self) -> DataFrame:
        """Accepted policies of a topic with several partitions, with their place in the order of all logs."""
        parsed = policies.parse_policies(tables.policy_topic(self.table("supplier")))
        return self._staged("topic_timeline", lambda: policies.accepted_timeline(
            self.bootstrap, policies.on_time_line(parsed), self.settings
        ), self.settings.reject_older_policies)

    @cached_property
    def timeline(self) -> DataFrame:
        return self.decided.where("accepted").select("seq", "policy")

    @cached_property
    def session_state(self) -> DataFrame:
        return self._staged(
            "state", lambda: incidents.session_state(self.events, self.settings),
            replace(self.settings, emit_updates=False),
        )

    @cached_property
    def emitted(self) -> DataFrame:
        return self._staged("emitted", lambda: incidents.emissions(self.session_state, self.settings), self.settings)

    def incidents(self, *rules: str) -> DataFrame:
        return incidents.session_incidents(
            self.events, self.timeline, self.settings, rules or SESSION_RULES, self.session_state,
            self.emitted,
        )

    @cached_property
    def embedded(self) -> DataFrame:
        return campaigns.embedded_findings(self.events, self.settings.campaigns)

    @cached_property
    def campaign_scan(self) -> DataFrame:
        return campaigns.scan_campaigns(self.embedded, self.settings)

    def all_incidents(self) -> DataFrame:
        """Session and campaign incidents in one output; disabled branches are not built."""
        parts = []
        if self.settings.incidents_enabled:
            parts.append(self.incidents())
        if self.settings.campaigns.enabled:
            parts.append(campaigns.campaign_incidents(self.campaign_scan))
        if not parts:
            return self.spark.createDataFrame([], INCIDENT)
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part, allowMissingColumns=True)
        return union


def flat(df: DataFrame) -> DataFrame:
    """Lists as text joined by ``,`` so that any engine can compare them."""
    return df.select(*[
        F.array_join(f.name, ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ])
