"""The whole job on bounded data: change feeds to enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsemill.operators.enrich import enrich_snapshot, latest_per_key
from pulsemill.sources.changes import (
    CONTENT_TABLE, ENGAGEMENT_TABLE, content_changes, engagement_changes, for_table, include,
)


def enriched_from_feed(feed: DataFrame, keep_extras: bool = False) -> DataFrame:
    """Route a mixed feed, unwrap both tables, keep the newest catalogue, enrich."""
    feed = include(feed)
    events = engagement_changes(for_table(feed, ENGAGEMENT_TABLE), keep_extras)
    events = events.drop("seq", "arrival_ts")
    catalogue = latest_per_key(content_changes(for_table(feed, CONTENT_TABLE)))
    return enrich_snapshot(events, catalogue)
