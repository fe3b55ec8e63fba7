"""Structured Streaming sources, sinks and views."""
