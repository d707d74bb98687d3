"""Structured Streaming forms of the speed layer and the combined view."""
