"""Structured Streaming jobs that call the batch operators."""
