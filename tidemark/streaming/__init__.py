"""Structured Streaming versions of the monthly operators."""
