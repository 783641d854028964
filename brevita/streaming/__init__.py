"""Structured Streaming jobs over the request log and the candidate history."""
