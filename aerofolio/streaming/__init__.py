"""Structured Streaming jobs over the provisional feed."""
