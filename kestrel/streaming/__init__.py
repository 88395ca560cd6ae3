"""Structured Streaming re-aims of the reference's chunked batch jobs."""
