"""Bounded tables: catalogue snapshots and the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from pulsemill.schemas import ENRICHED

FOLDERS = [
    T.StructField("event_date", T.DateType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]


def read_warehouse(spark: SparkSession, path: str, promoted: T.StructType | None = None) -> DataFrame:
    """The enriched table; folders give ``event_date``, ``writer`` and ``batch_id``.

    ``promoted`` columns are null in batches written before they were promoted.
    """
    own = promoted.fields if promoted else []
    return spark.read.schema(T.StructType([*ENRICHED.fields, *own, *FOLDERS])).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A source table exported to Parquet."""
    return spark.read.parquet(path)


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 1,
) -> DataFrame:
    """A source table over JDBC.

    With a split column and its bounds the read runs as ``splits`` range
    queries; without, one task reads the table, which suits a small catalogue
    only.
    """
    if split_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        raise ValueError("a split column needs its lower and upper bound")
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=split_column, lowerBound=low, upperBound=high,
        numPartitions=splits, properties=properties,
    )


def content_ids(content: DataFrame) -> DataFrame:
    return content.select("id")
