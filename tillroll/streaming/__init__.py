"""Structured Streaming queries built from the same transforms as the batch jobs."""
