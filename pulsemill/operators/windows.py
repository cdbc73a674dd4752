"""Event-time windows and deduplication, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(
    events: DataFrame, width: str = "1 hour", lateness: str | None = None, *keys: str
) -> DataFrame:
    """Events per window of ``width`` and key; windows begin at whole multiples since the epoch.

    A stream needs ``lateness``: windows close, and leave the state, that much behind
    the newest event time.
    """
    if lateness:
        events = events.withWatermark("event_ts", lateness)
    counted = events.groupBy(F.window("event_ts", width).alias("w"), *keys).agg(F.count("*").alias("n_events"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n_events")


def dedup_events(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """One row per event id.

    In a batch the one with the least position, then event time, then its fields as text. In
    a stream the first to arrive; ids are remembered for ``lateness`` of event time.
    """
    if lateness:
        return events.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["id"])
    columns = [c for c in events.columns if c != "id"]
    order = F.struct(*[F.col(c) for c in ("seq", "event_ts") if c in columns], F.to_json(F.struct(*columns)))
    least = events.groupBy("id").agg(F.min_by(F.struct(*columns), order).alias("row"))
    return least.select(*[F.col("id") if c == "id" else F.col(f"row.{c}") for c in events.columns])
