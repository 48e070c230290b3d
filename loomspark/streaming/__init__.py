"""Structured Streaming twins of the batch operators, and event-time windows."""
