"""Structured Streaming forms of the jobs. Checkpoint locations are mandatory."""
