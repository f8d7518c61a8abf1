"""Structured Streaming pricing job."""
