"""Structured Streaming versions of the online behaviours."""
