"""Whole jobs: which operators run over which tables."""
