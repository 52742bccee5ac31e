"""Streaming twins of the weekly aggregates."""
