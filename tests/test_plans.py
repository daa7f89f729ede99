"""Shapes of physical plans that results alone do not show."""

import re

import pytest

from railwatch.operators import incidents, intake
from railwatch.plans.catalog import QUERIES
from railwatch.plans.pipeline import Pipeline
from railwatch.settings import Settings

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipeline(spark):
    return Pipeline(spark, SF)


@pytest.mark.parametrize("name", [
    "guardrail_agg_all", "policy_asof", "session_epochs", "session_incidents", "pi_campaigns", "nearest_centroid",
    "report_intake", "findings_around_requests", "enriched_findings",
])
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_json_is_read_once_per_row(pipeline):
    kept = intake.valid(intake.parse(pipeline.raw))
    assert plan(kept).count("from_json") == 1


def test_scans_read_only_their_columns(pipeline):
    text = plan(incidents.session_epochs(pipeline.events))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "rawPayload" not in schema and "evidenceSnippet" not in schema
    assert "GreaterThan" in text or "PushedFilters: [IsNotNull(eventType)" in text


def test_request_ids_are_limited_before_the_shuffle(pipeline):
    text = plan(incidents.first_seen_lists(pipeline.session_state, Settings(max_request_ids=50)))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_raw_findings_use_a_hash_aggregate(pipeline):
    from railwatch.operators.aggregates import value_counts

    text = plan(value_counts(pipeline.events, 60_000))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["escalations", "rising_injections", "runaway_agents"])
def test_ordered_patterns_read_and_shuffle_once(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 1


def test_session_scans_move_and_stage_little(pipeline, spark):
    """Copies of findings that only count carry no texts, and staged tables are written with the tighter codec."""
    from railwatch.sources.staging import staged

    text = plan(incidents.session_state(pipeline.events))
    assert re.search(r"CASE WHEN \(own#\d+ = 1\) THEN requestId", text)
    written = staged(spark.range(1_000).selectExpr("id", "md5(string(id)) AS text"), "codec")
    assert written.inputFiles() and all(f.endswith(".zstd.parquet") for f in written.inputFiles())
