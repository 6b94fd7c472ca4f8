"""Batch and stream sources."""
