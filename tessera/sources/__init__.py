"""Readers and table adapters."""
