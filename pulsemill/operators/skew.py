"""Joins that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024  # files are compressed; in memory it is a few times that
HOT_ROWS = 1_000_000  # what one task handles with ease


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, None where it cannot be asked."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``min_rows`` rows: at most one for each so many rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key).agg(F.count("*").alias("key_rows"))
        .where(F.col("key_rows") > min_rows)
    )


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    columns: list[str],
    found: str = "found",
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Left join to a table with one row per key; adds ``columns`` and ``found``.

    A lookup table of checked size is broadcast: the facts are not shuffled at
    all.  Beyond that one sort-merge join reads the facts once; adaptive execution
    splits the partitions of frequent keys and repeats their one lookup row.
    Facts without a key match nothing and are spread instead of shuffled together.
    """
    side = lookup.select(
        F.col(lookup_key).alias("__key"), *columns, F.lit(True).alias("__hit")
    )
    result = [
        *[F.col(c) for c in facts.columns], *[F.col(c) for c in columns],
        F.coalesce(F.col("__hit"), F.lit(False)).alias(found),
    ]
    same_key = F.col(fact_key) == F.col("__key")
    if fits_broadcast(side, broadcast_bytes):
        return facts.join(F.broadcast(side), same_key, "left").select(*result)

    keyless = F.when(F.col(fact_key).isNull(), F.xxhash64(*[F.col(c) for c in facts.columns if _hashable(facts, c)]))
    spread = facts.withColumn("__spread", keyless)
    # null for every key, but no literal that would be folded out of the join keys
    side = side.withColumn("__none", F.when(F.col("__key").isNull(), F.lit(0).cast("bigint")))
    matches = same_key & F.col("__spread").eqNullSafe(F.col("__none"))
    return spread.join(side.hint("merge"), matches, "left").select(*result)


def _hashable(df: DataFrame, column: str) -> bool:
    return not any(kind in df.schema[column].dataType.simpleString() for kind in ("map<", "variant"))
