"""Operators over raw events and logs."""
