"""Structured Streaming versions of the booking workflow."""
