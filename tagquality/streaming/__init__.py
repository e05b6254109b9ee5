"""Structured Streaming: health results in, JSON events out."""
