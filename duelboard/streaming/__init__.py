"""Structured Streaming forms of the incremental workflows."""
