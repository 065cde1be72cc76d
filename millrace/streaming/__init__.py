"""Incremental loads with Structured Streaming: run until nothing new is left, then stop."""
