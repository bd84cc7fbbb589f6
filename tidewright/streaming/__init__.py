"""Structured Streaming jobs over file sources."""
