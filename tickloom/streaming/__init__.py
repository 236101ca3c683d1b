"""Structured Streaming queries and the state they keep between micro-batches."""
