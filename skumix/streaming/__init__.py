"""Structured Streaming: period-by-period segment monitoring."""

from .monitor import TX_STREAM_SCHEMA, start_transition_monitor  # noqa: F401
