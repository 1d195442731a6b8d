"""Structured Streaming jobs; each restarts from its checkpoint."""
