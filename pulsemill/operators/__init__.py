"""Operators on DataFrames: lookup and as-of enrichment, checks, counters."""
