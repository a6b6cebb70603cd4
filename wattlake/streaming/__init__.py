"""Streaming versions of the sample and fact steps."""
