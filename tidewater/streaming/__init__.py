"""Structured Streaming form of the incremental pull."""
