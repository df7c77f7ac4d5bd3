"""Structured Streaming forms of the timer-driven steps."""
