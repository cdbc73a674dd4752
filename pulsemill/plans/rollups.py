"""Daily rollups of the enriched table that merge into any range of days.

A rollup row holds, per day and key, what can be merged: counts, moments, co-moments and
sketches. Rows of different batches and days merge alike, so every batch of a stream writes
its own rows once, into a folder it owns, and a query adds up whole days and reads events only
for the ragged ends of its range.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.timefuncs import Instant, _utc_midnight, _with_date_range, hours_before, instant, utc_day
from pulsemill.sinks.folders import own_folder

SKETCH_BITS = 12  # distinct counts are exact below 2^12 items a key, within about 3 % beyond

TYPE_DEVICE, CONTENT, USER_PLAYS = "type_device", "content", "user_plays"
KEYS = {TYPE_DEVICE: ["content_type", "device"], CONTENT: ["content_id"], USER_PLAYS: ["user_id"]}
MIN_SECONDS = 10  # of the events whose share's spread is kept apart


def moments(x: Column) -> Column:
    """Number, mean and sum of squared differences from it."""
    return F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"))


def co_moments(x: Column, y: Column) -> Column:
    """Moments of the pairs that have both, and the sum of products of differences."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    n = F.count(x)
    return F.struct(
        n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"), F.avg(y).alias("other_mean"),
        (F.var_pop(y) * n).alias("other_m2"), (F.covar_pop(x, y) * n).alias("c"))


def _measures(name: str) -> list[Column]:
    pct, seconds = F.col("engagement_pct"), F.col("engagement_seconds")
    return {
        TYPE_DEVICE: [
            moments(pct).alias("pct"), moments(seconds).alias("seconds"),
            moments(F.when(seconds > MIN_SECONDS, pct)).alias("pct_of_longer"),
            co_moments(pct, F.col("length_seconds")).alias("pct_length"),
            F.count_if(seconds > MIN_SECONDS).alias("n_longer"),
            F.kll_sketch_agg_double("engagement_seconds").alias("seconds_sketch")],
        CONTENT: [moments(pct).alias("pct")],
        USER_PLAYS: [moments(pct).alias("pct"), F.theta_sketch_agg("content_id", F.lit(SKETCH_BITS)).alias("items")],
    }[name]


def rolled_up(events: DataFrame, name: str) -> DataFrame:
    """Rollup rows (event_date, keys, n_events, measures) of some events."""
    if name == USER_PLAYS:
        events = events.where(F.col("event_type") == "play")
    day = utc_day(F.col("event_ts"), events.schema["event_ts"].dataType)
    return events.withColumn("event_date", day).groupBy("event_date", *KEYS[name]).agg(
        F.count("*").alias("n_events"), *_measures(name))


def write_batch(events: DataFrame, path: str, batch_id: int, writer: str | None = None) -> None:
    """The rollup rows of one batch; writing it again replaces them."""
    for name in KEYS:
        rows = rolled_up(events, name)
        rows.write.mode("overwrite").parquet(own_folder(events.sparkSession, f"{path}/{name}", batch_id, writer))


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}").drop("writer", "batch_id")


def compact(spark: SparkSession, path: str, name: str, target: str) -> None:
    """One row per day and key instead of one per batch, into another table."""
    rows = read(spark, path, name)
    keys = ["event_date", *KEYS[name]]
    merged_rows = rows.groupBy(*keys).agg(F.sum("n_events").alias("n_events"), *[
        f(c).alias(c) for c, f in _SUMS.items() if c in rows.columns])
    for column in ("pct", "seconds", "pct_of_longer", "pct_length"):
        if column in rows.columns:
            merged_rows = _joined(merged_rows, merged(rows, keys, column).select(
                *keys, F.struct(*rows.schema[column].dataType.fieldNames()).alias(column)), keys)
    merged_rows.select(*rows.columns).write.mode("overwrite").parquet(f"{target}/{name}/writer=compact/batch_id=0")


_SUMS: dict[str, Callable[[str], Column]] = {
    "n_longer": F.sum, "seconds_sketch": F.kll_merge_agg_double, "items": F.theta_union_agg}


def over(rollup: DataFrame, events: DataFrame, name: str, start: Column, end: Column) -> DataFrame:
    """Rollup rows for ``start <= event_ts <= end``: whole days as kept, the ragged ends from the events.

    Only the days of the two ends are read from a table that is partitioned by event_date.
    """
    dtype = events.schema["event_ts"].dataType
    day = utc_day(start, dtype)
    first = F.when(start == _utc_midnight(start, dtype), day).otherwise(F.date_add(day, 1))
    last = F.date_sub(utc_day(end, dtype), 1)
    in_range = _with_date_range(events, F.col("event_ts").between(start, end), start, end, dtype)
    ends = in_range.where(~utc_day(F.col("event_ts"), dtype).between(first, last))
    if "event_date" in events.columns:
        ends = ends.where(~F.col("event_date").between(first, last)).drop("event_date")
    return rollup.where(F.col("event_date").between(first, last)).unionByName(rolled_up(ends, name))


def over_days(rollup: DataFrame, events: DataFrame, name: str, days: int, as_of: Instant = None) -> DataFrame:
    """The same for the ``days`` x 24 hours up to and including ``as_of``."""
    end = instant(as_of, events.schema["event_ts"].dataType)
    return over(rollup, events, name, hours_before(end, 24 * days), end)


def over_range(rollup: DataFrame, events: DataFrame, name: str, start: Instant, end: Instant) -> DataFrame:
    dtype = events.schema["event_ts"].dataType
    return over(rollup, events, name, instant(start, dtype), instant(end, dtype))


def _joined(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys that may be null."""
    b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return a.join(b, on).drop(*[f"_{k}" for k in keys])


def merged(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, n, mean, m2[, other_mean, other_m2, c]) over all rows of a key.

    The parallel formula for any number of parts: a part of mean m adds its own sum of
    squares and n (m - mean)^2. Two passes over the narrow rows, both combined before the
    shuffle, so no key's rows come together.
    """
    parts = rows.select(*keys, f"{column}.*")
    two = "c" in parts.columns
    n, mean, other = F.col("n"), F.col("mean"), F.col("other_mean")
    centres = [F.sum("n").alias("total"), F.try_divide(F.sum(n * mean), F.sum("n")).alias("centre")]
    if two:
        centres.append(F.try_divide(F.sum(n * other), F.sum("n")).alias("other_centre"))
    parts = _joined(parts, parts.groupBy(*keys).agg(*centres), keys)
    step, other_step = mean - F.col("centre"), other - F.col("other_centre")
    out = [F.max("total").alias("n"), F.max("centre").alias("mean"), F.sum(F.col("m2") + n * step * step).alias("m2")]
    if two:
        out += [F.max("other_centre").alias("other_mean"), F.sum(F.col("other_m2") + n * other_step * other_step).alias("other_m2"),
                F.sum(F.col("c") + n * step * other_step).alias("c")]
    return parts.groupBy(*keys).agg(*out)


def _variance() -> Column:
    return F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))


def type_device_engagement(rows: DataFrame) -> DataFrame:
    """As ``insights.type_device_engagement``."""
    keys = ["content_type", "device"]
    return merged(rows, keys, "pct").select(*keys, F.col("mean").alias("avg_engagement_pct"))


def device_variability(rows: DataFrame) -> DataFrame:
    """As ``insights.device_variability``, for events of more than MIN_SECONDS."""
    return merged(rows.where("n_longer > 0"), ["device"], "pct_of_longer").select(
        "device", F.sqrt(_variance()).alias("stddev_engagement_pct"))


def device_statistics(rows: DataFrame) -> DataFrame:
    """As ``insights.device_statistics``."""
    return merged(rows, ["device"], "seconds").select(
        "device", F.col("mean").alias("avg_engagement"), F.sqrt(_variance()).alias("stddev_engagement"))


def inconsistent_content(rows: DataFrame, top: int = 10) -> DataFrame:
    """As ``insights.inconsistent_content``."""
    return merged(rows, ["content_id"], "pct").select("content_id", _variance().alias("engagement_variance")).orderBy(
        F.desc_nulls_last("engagement_variance"), "content_id").limit(top)


def length_correlation(rows: DataFrame) -> DataFrame:
    """As ``insights.length_correlation``."""
    return merged(rows, ["content_type"], "pct_length").select(
        "content_type", F.try_divide("c", F.sqrt("m2") * F.sqrt("other_m2")).alias("pct_length_correlation"))


def p90_seconds_by_type(rows: DataFrame, share: float = 0.9) -> DataFrame:
    """As ``insights.p90_seconds_by_type``, from sketches: a rank within about 2 % of the share."""
    merged_rows = rows.groupBy("content_type").agg(F.kll_merge_agg_double("seconds_sketch").alias("sketch"))
    quantile = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged_rows.select("content_type", quantile.alias("percentile_90_engagement_seconds"))


def user_engagement_patterns(rows: DataFrame, min_events: int = 5, top: int = 100) -> DataFrame:
    """As ``insights.user_engagement_patterns``; distinct items from merged sketches."""
    counts = rows.groupBy("user_id").agg(
        F.sum("n_events").alias("total_events"),
        F.theta_sketch_estimate(F.theta_union_agg("items")).alias("unique_content"))
    shares = merged(rows, ["user_id"], "pct").select("user_id", F.col("mean").alias("avg_engagement_pct"))
    return _joined(counts.where(F.col("total_events") >= min_events), shares, ["user_id"]).orderBy(
        F.desc_nulls_last("avg_engagement_pct"), "user_id").limit(top)
