"""Streaming face of the batch build."""
