"""Incremental profiling over an arriving event stream."""

from cohortlens.streaming.rates import appointment_stream, streaming_rate_by

__all__ = ["appointment_stream", "streaming_rate_by"]
