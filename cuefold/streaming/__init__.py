"""Streaming of timed text."""
