"""Whole reporting pipelines: pure functions from frames and an as-of time to frames."""
