"""Scans, samples, sinks and stage tables."""
