"""Streaming: a Structured Streaming trigger for the daily cumulative load."""
