"""Micro-batches, the store and its metrics."""
