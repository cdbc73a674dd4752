"""Checks the source tables and the warehouse contract impose."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.operators.skew import DEFAULT_BROADCAST_BYTES, lookup_join
from pulsemill.schemas import REQUIRED_COLUMNS


def with_missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Add ``missing``: names of the required columns that are null."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return df.withColumn("missing", F.array_compact(F.array(*names)))


def split_required(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """(rows fit for the warehouse, rejects with the failing column names)."""
    checked = with_missing_columns(df, tuple(required))
    fits = F.size("missing") == 0
    return checked.where(fits).drop("missing"), checked.where(~fits)


def domain_rejects(df: DataFrame, allowed: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rows with a value outside a column's code list; null passes, as in CHECK."""
    bad = [F.when(~F.col(c).isin(*codes), F.lit(c)) for c, codes in allowed.items()]
    checked = df.withColumn("violations", F.array_compact(F.array(*bad)))
    return checked.where(F.size("violations") > 0)


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    counts = df.where(~_any_null(key)).groupBy(*key).agg(F.count("*").alias("copies"))
    return counts.where(F.col("copies") > 1)


def _any_null(columns: Iterable[str]):
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return condition


def referential_rejects(
    events: DataFrame,
    content: DataFrame,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Events whose content id is not in the catalogue; a null id passes."""
    checked = lookup_join(
        events, content, "content_id", "id", [],
        broadcast_bytes=broadcast_bytes,
    )
    return checked.where(~F.col("found") & F.col("content_id").isNotNull()).drop("found")


def quality_report(
    events: DataFrame,
    content: DataFrame,
    allowed: Mapping[str, Iterable[str]],
    required: Iterable[str] = REQUIRED_COLUMNS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """One row (rule, subject, n_rows) per check, also for those that nothing violates.

    The row checks and the reference share one pass over the events; only the
    duplicates of the key need their own aggregate.
    """
    joined = lookup_join(events, content, "content_id", "id", [], broadcast_bytes=broadcast_bytes)
    rules = {("required", c): F.col(c).isNull() for c in required}
    rules |= {("domain", c): ~F.col(c).isin(*codes) for c, codes in allowed.items()}
    rules["reference", "content_id"] = ~F.col("found") & F.col("content_id").isNotNull()
    counted = joined.agg(*[F.count_if(v).alias(f"{rule}|{c}") for (rule, c), v in rules.items()])
    rows = counted.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("subject"), F.col(f"{rule}|{c}").alias("n_rows"))
        for rule, c in rules
    ])))
    copies = duplicate_keys(events, "id").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"))
    return rows.unionByName(copies.select(F.lit("unique").alias("rule"), F.lit("id").alias("subject"), "n_rows"))
