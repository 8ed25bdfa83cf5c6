"""Registered queries (one module per build-plan group)."""
