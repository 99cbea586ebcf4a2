"""Structured Streaming wiring around the shared operators."""
