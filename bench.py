"""Headline queries on local cores; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8).
The first query of a chain pays for the tables that later ones read (``parse_and_route``).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from railwatch.plans.catalog import QUERIES
from railwatch.plans.pipeline import Pipeline

HEADLINE = (
    "guardrail_agg_1m", "guardrail_agg_5m", "guardrail_agg_all", "guardrail_agg_compact", "guardrail_quality",
    "policy_asof", "session_epochs", "session_incidents", "incident_updates", "hash_embedding", "pi_campaigns",
    "nearest_centroid", "report_quality_by_guardrail", "report_incidents_by_rule", "stream_intake",
    "stream_guardrail_agg",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("railwatch-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="railwatch-bench-"))
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    took = {"parse_and_route": seconds(lambda: Pipeline(spark, sf_dir).events)}
    for name in HEADLINE:
        took[name] = seconds(lambda: run(QUERIES[name](spark, sf_dir)))
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": sf_dir.rsplit("sf", 1)[-1], "events": events,
        # Only of steps that start from raw events; the others read tables that an earlier step wrote.
        "events_per_second": {
            "parse_and_route": round(events / took["parse_and_route"]), "stream_intake": round(events / took["stream_intake"]),
            "raw_to_first_aggregates": round(events / (took["parse_and_route"] + took["guardrail_agg_1m"])),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
