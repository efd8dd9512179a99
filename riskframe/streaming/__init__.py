"""Structured Streaming re-expression of the scoring step."""
