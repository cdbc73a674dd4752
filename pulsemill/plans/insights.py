"""The analytics library: queries on the enriched table.

Each function takes the enriched table and returns a lazy DataFrame.  Relative
ranges end at ``as_of`` (default: now), fixed ones are parameters.  Ties in
ordered results are broken by the group key, so repeated runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.functions.measures import quantile_at
from pulsemill.functions.timefuncs import Instant, between, last_days, on_date, since_date


def engagement_by_content_type(enriched: DataFrame, day: Instant = None) -> DataFrame:
    """Events, mean share and mean seconds per content type on one day."""
    return (
        on_date(enriched, day)
        .where(F.col("engagement_pct").isNotNull())
        .groupBy("content_type")
        .agg(
            F.count("*").alias("total_events"),
            F.avg("engagement_pct").alias("avg_engagement_pct"),
            F.avg("engagement_seconds").alias("avg_engagement_seconds"),
        )
        .orderBy(F.desc_nulls_last("avg_engagement_pct"), "content_type")
    )


def user_engagement_patterns(
    enriched: DataFrame, today: Instant = None, days: int = 7, min_events: int = 5, top: int = 100
) -> DataFrame:
    """Most engaged users by plays: events, distinct items, mean share."""
    return (
        since_date(enriched, days, today)
        .where(F.col("event_type") == "play")
        .groupBy("user_id")
        .agg(
            F.count("*").alias("total_events"),
            F.countDistinct("content_id").alias("unique_content"),
            F.avg("engagement_pct").alias("avg_engagement_pct"),
        )
        .where(F.col("total_events") >= min_events)
        .orderBy(F.desc_nulls_last("avg_engagement_pct"), "user_id")
        .limit(top)
    )


def content_performance(
    enriched: DataFrame, today: Instant = None, days: int = 30, min_plays: int = 10
) -> DataFrame:
    """Completion of played items with enough plays."""
    return (
        since_date(enriched, days, today)
        .where((F.col("event_type") == "play") & F.col("engagement_pct").isNotNull())
        .groupBy("content_id", "content_type", "length_seconds")
        .agg(
            F.count("*").alias("play_events"),
            F.avg("engagement_pct").alias("avg_completion_pct"),
            F.count_if(F.col("engagement_pct") >= 90).alias("high_engagement_users"),
        )
        .where(F.col("play_events") >= min_plays)
        .orderBy(F.desc_nulls_last("avg_completion_pct"), "content_id")
    )


def type_device_engagement(enriched: DataFrame, as_of: Instant = None, days: int = 7) -> DataFrame:
    """Mean share by content type and device."""
    return (
        last_days(enriched, days, as_of)
        .groupBy("content_type", "device")
        .agg(F.avg("engagement_pct").alias("avg_engagement_pct"))
    )


def p90_seconds_by_type(
    enriched: DataFrame, as_of: Instant = None, days: int = 30, accuracy: int = 10_000
) -> DataFrame:
    """90th percentile of engaged seconds by content type."""
    return (
        last_days(enriched, days, as_of)
        .groupBy("content_type")
        .agg(
            quantile_at("engagement_seconds", 100, 90, accuracy)
            .alias("percentile_90_engagement_seconds")
        )
    )


def _ranked(df: DataFrame, key: str, measure: Column, name: str, top: int) -> DataFrame:
    """The ``top`` groups by an aggregate, largest first."""
    return (
        df.groupBy(key).agg(measure.alias(name)).orderBy(F.desc_nulls_last(name), key).limit(top)
    )


def top_device(enriched: DataFrame, as_of: Instant = None, days: int = 30, top: int = 1) -> DataFrame:
    """Device with the longest mean play."""
    plays = last_days(enriched, days, as_of).where(F.col("event_type") == "play")
    return _ranked(plays, "device", F.avg("engagement_seconds"), "avg_engagement_seconds", top)


def device_variability(
    enriched: DataFrame, as_of: Instant = None, days: int = 30, min_seconds: float = 10
) -> DataFrame:
    """Spread of the share by device, short engagements left out."""
    return (
        last_days(enriched, days, as_of)
        .where(F.col("engagement_seconds") > min_seconds)
        .groupBy("device")
        .agg(F.stddev_samp("engagement_pct").alias("stddev_engagement_pct"))
    )


def median_seconds_of_engaged(
    enriched: DataFrame,
    as_of: Instant = None,
    days: int = 30,
    min_pct: float = 50,
    accuracy: int = 10_000,
) -> DataFrame:
    """Median seconds by content type among events above a share."""
    return (
        last_days(enriched, days, as_of)
        .where(F.col("engagement_pct") > min_pct)
        .groupBy("content_type")
        .agg(quantile_at("engagement_seconds", 2, 1, accuracy).alias("median_engagement_seconds"))
    )


def top_content_on_device(
    enriched: DataFrame, device: str = "ios", as_of: Instant = None, days: int = 30, top: int = 3
) -> DataFrame:
    """Items with the longest mean engagement on one device."""
    rows = last_days(enriched, days, as_of).where(F.col("device") == device)
    return _ranked(rows, "content_id", F.avg("engagement_seconds"), "avg_engagement_seconds", top)


def long_content_engagement(
    enriched: DataFrame, as_of: Instant = None, days: int = 30, min_length: int = 60
) -> DataFrame:
    """Mean share per item longer than ``min_length`` seconds."""
    return (
        last_days(enriched, days, as_of)
        .where(F.col("length_seconds") > min_length)
        .groupBy("content_id")
        .agg(F.avg("engagement_pct").alias("avg_engagement_pct"))
    )


def device_statistics(enriched: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """Mean and spread of engaged seconds by device in a fixed range."""
    return (
        between(enriched, start, end)
        .groupBy("device")
        .agg(
            F.avg("engagement_seconds").alias("avg_engagement"),
            F.stddev_samp("engagement_seconds").alias("stddev_engagement"),
        )
    )


def most_engaging_content_per_user(enriched: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """Item with the highest share per user; null for users without any share."""
    best = F.max_by(
        "content_id",
        F.when(
            F.col("engagement_pct").isNotNull(), F.struct("engagement_pct", "content_id")
        ),
    )
    return (
        between(enriched, start, end).groupBy("user_id").agg(best.alias("most_engaging_content"))
    )


def inconsistent_content(
    enriched: DataFrame, start: Instant, end: Instant, top: int = 10
) -> DataFrame:
    """Items whose share varies most."""
    return _ranked(
        between(enriched, start, end), "content_id",
        F.var_samp("engagement_pct"), "engagement_variance", top,
    )


def length_correlation(enriched: DataFrame, as_of: Instant = None, days: int = 7) -> DataFrame:
    """Correlation of share and content length by content type."""
    return (
        last_days(enriched, days, as_of)
        .groupBy("content_type")
        .agg(F.corr("engagement_pct", "length_seconds").alias("pct_length_correlation"))
    )


def top_types_per_device(
    enriched: DataFrame, as_of: Instant = None, days: int = 30, top: int = 5
) -> DataFrame:
    """Content types with the highest mean share for each device."""
    by_share = Window.partitionBy("device").orderBy(
        F.desc_nulls_last("avg_engagement_pct"), "content_type"
    )
    return (
        last_days(enriched, days, as_of)
        .groupBy("device", "content_type")
        .agg(F.avg("engagement_pct").alias("avg_engagement_pct"))
        .withColumn("place", F.row_number().over(by_share))
        .where(F.col("place") <= top)
    )


def total_events(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("total_events"))


def recent_events(enriched: DataFrame, top: int = 10) -> DataFrame:
    """Newest rows of the table, all columns."""
    return enriched.orderBy(F.desc("event_ts"), F.desc("id")).limit(top)


def source_counts(content: DataFrame, engagement: DataFrame) -> DataFrame:
    """Row counts of the two source tables."""
    return content.agg(F.count("*").alias("n_rows")).select(
        F.lit("content").alias("source_table"), "n_rows"
    ).unionByName(
        engagement.agg(F.count("*").alias("n_rows")).select(
            F.lit("engagement_events").alias("source_table"), "n_rows"
        )
    )
