"""Batch enrichment: attach catalogue attributes to events, derive measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.measures import with_measures
from pulsemill.operators.skew import DEFAULT_BROADCAST_BYTES, lookup_join

ATTRIBUTES = ["content_type", "length_seconds"]


def finish(joined: DataFrame, known: str = "found") -> DataFrame:
    """Measures and the missing flag; all derived fields are null without content."""
    df = with_measures(joined, F.col(known))
    return df.withColumn("content_missing", ~F.col(known)).drop(known)


def enrich_snapshot(
    events: DataFrame,
    content: DataFrame,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Enrich events from a catalogue with one version per item."""
    joined = lookup_join(
        events, content, "content_id", "id", ATTRIBUTES,
        broadcast_bytes=broadcast_bytes,
    )
    return finish(joined)


def latest_per_key(changes: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Newest row per key of a change feed.

    ``max_by`` combines before the shuffle: a key with very many versions sends
    one row per task.
    """
    rest = [c for c in changes.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.col(order)).alias("row")
    return changes.groupBy(key).agg(newest).select(key, *[F.col(f"row.{c}") for c in rest])


def tagged_union(events: DataFrame, content: DataFrame) -> DataFrame:
    """Both feeds keyed by content id, told apart by ``tag``."""
    main = events.select(
        F.col("content_id"), F.lit("main").alias("tag"), F.col("id").alias("event_id"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("bigint").alias("length_seconds"),
    )
    side = content.select(
        F.col("id").alias("content_id"), F.lit("content").alias("tag"),
        F.lit(None).cast("bigint").alias("event_id"), "content_type", "length_seconds",
    )
    return main.unionByName(side)
