"""Scans, contracts and sinks."""
