"""Ordered release, following, handoff, consumers, health and metrics."""
