"""Readers: change feeds, catalogue snapshots, warehouse tables, test tables."""
