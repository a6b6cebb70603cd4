"""Stored tables and adapters."""
