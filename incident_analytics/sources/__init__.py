"""Readers, writers, dimensions, scratch storage and test-table adapters."""
