"""Structured Streaming forms of batch scoring and of the daily failure roll-up."""

from vigil.streaming.jobs import daily_error_counts, run_available, scoring_stream  # noqa: F401
