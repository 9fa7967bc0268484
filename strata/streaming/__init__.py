"""Incremental landing of payload files with Structured Streaming."""

from strata.streaming.landing import land_incrementally, payload_stream  # noqa: F401
