"""Guardrail analytics for LLM-safety telemetry, written as Spark DataFrame jobs."""
