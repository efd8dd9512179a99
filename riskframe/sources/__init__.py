"""Scans and sinks through Spark readers and writers."""
