"""Outcome counters and the number of known content items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ENRICHMENT = "enrichment"


def outcome_columns() -> list[Column]:
    """Counts over enriched rows: enriched and missing events."""
    missing = F.col("content_missing")
    return [
        F.count_if(~missing).alias("enriched"),
        F.count_if(missing).alias("missing_content"),
    ]


def outcome_counts(enriched: DataFrame) -> DataFrame:
    """One row with the three counters of an as-of enrichment.

    ``flushed_pending`` counts drains, not drained events: an item drains once,
    when its first version comes.
    """
    per_item = enriched.groupBy("content_id").agg(
        F.count_if(~F.col("content_missing")).alias("enriched"),
        F.count_if(F.col("content_missing")).alias("missing_content"),
        F.max("drained").alias("drains"),
    )
    return per_item.agg(
        F.sum("enriched").alias("enriched"),
        F.sum("missing_content").alias("missing_content"),
        F.count_if(F.col("drains")).alias("flushed_pending"),
    )


def observed(df: DataFrame, name: str = ENRICHMENT) -> tuple[DataFrame, Observation]:
    """Count outcomes of a batch job while it runs; read ``.get`` afterwards."""
    watch = Observation(name)
    return df.observe(watch, *outcome_columns()), watch


def content_cache_size(content_rows: DataFrame) -> DataFrame:
    """Number of distinct items; as a stream, the running number (complete mode)."""
    return content_rows.select("id").dropDuplicates(["id"]).agg(
        F.count("*").alias("cached_items")
    )


def receipt_counts(receipts: DataFrame) -> DataFrame:
    """Sink counters from delivery or write receipts."""
    return receipts.groupBy("sink", "status").agg(
        F.count("*").alias("requests"), F.sum("n_events").alias("events")
    )
