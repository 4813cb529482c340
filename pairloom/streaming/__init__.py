"""Structured Streaming versions of operators that run on arriving data."""
