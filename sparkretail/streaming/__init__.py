"""Streaming variants of the staging models."""
