"""Sinks: warehouse table, key-value projection, batched delivery."""
