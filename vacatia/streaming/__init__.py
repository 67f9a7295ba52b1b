"""Incremental state with Structured Streaming, and its batch twins."""
