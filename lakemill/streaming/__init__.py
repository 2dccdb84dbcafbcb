"""Structured Streaming forms of three batch jobs."""
