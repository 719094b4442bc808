"""Structured Streaming forms of the jobs: event time, watermarks, sinks, late data."""
