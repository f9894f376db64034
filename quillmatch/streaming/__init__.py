"""Streaming of the engine."""
