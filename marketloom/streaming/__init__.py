"""Structured Streaming of feedback events."""
