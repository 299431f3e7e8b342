"""Structured Streaming jobs that run the operators on topics."""
