"""The enriched table: Parquet folders by UTC date, then by batch; clustered files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from pulsemill.functions.timefuncs import utc_date
from pulsemill.operators.quality import split_required
from pulsemill.sinks.folders import replace_batch
from pulsemill.sources.tables import read_warehouse
from pulsemill.schemas import (
    ENRICHED, TABLE_DESCRIPTION, TABLE_LABELS, conform, with_comments,
)

CLUSTER_BY = ("content_type", "event_type")
COMPACTED = "compacted"


def warehouse_rows(
    enriched: DataFrame, include_missing: bool = False, promoted: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows of the table's schema, rejects that lack a required column).

    The table has no missing flag, so events without content stay out unless
    asked for. ``promoted`` columns follow those of the schema.
    """
    if "content_missing" in enriched.columns and not include_missing:
        enriched = enriched.where(~F.col("content_missing"))
    good, rejects = split_required(enriched)
    schema = T.StructType([*ENRICHED.fields, *[good.schema[c] for c in promoted]])
    return with_comments(conform(good, schema)), rejects


def laid_out(rows: DataFrame, rebalance: bool = True) -> DataFrame:
    """Add ``event_date`` and order rows as the table is clustered.

    ``rebalance`` brings rows of a date and cluster together before writing, so
    there are few files and their statistics are tight; adaptive execution
    splits a group that is too big for one task.  Small batches of a stream are
    written where they are.
    """
    rows = rows.withColumn("event_date", utc_date(rows))
    if rebalance:
        rows = rows.hint("rebalance", "event_date", *CLUSTER_BY)
    return rows.sortWithinPartitions("event_date", *CLUSTER_BY)


def write_batch(
    rows: DataFrame, path: str, batch_id: int, rebalance: bool = True, writer: str | None = None
) -> None:
    """Append one batch to the table at ``path``, creating it if needed.

    Below each date a batch owns a folder of its writer and number: writing it
    again after a failure replaces that, so no row is lost or doubled, and
    another query's batch of the same number stays.
    """
    replace_batch(laid_out(rows, rebalance), path, ["event_date"], batch_id, writer)


def append_table(rows: DataFrame, table: str) -> None:
    """Append to a catalog table, created with layout and comments if needed."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        spark.sql(create_table_sql(table))
    laid_out(rows).select(*ENRICHED.fieldNames(), "event_date").write.mode("append").insertInto(table)


def create_table_sql(table: str) -> str:
    """DDL of the catalog table: columns, comments, partitions, properties."""
    columns = [
        f"{f.name} {f.dataType.simpleString()} COMMENT '{f.metadata['comment']}'"
        for f in ENRICHED.fields
    ]
    columns.append("event_date date COMMENT 'UTC date of event_ts'")
    labels = ", ".join(f"'{k}' = '{v}'" for k, v in TABLE_LABELS.items())
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet "
        f"PARTITIONED BY (event_date) COMMENT '{TABLE_DESCRIPTION}' TBLPROPERTIES ({labels})"
    )


def compact(
    spark: SparkSession, path: str, target: str, first_date: str | None = None, last_date: str | None = None
) -> None:
    """Rewrite the many small folders of stream batches, for a range of dates, as one batch.

    The target is another table; a stream may go on writing to it, since the
    compacted rows are a writer of their own.
    """
    rows = read_warehouse(spark, path)
    if first_date:
        rows = rows.where(F.col("event_date") >= F.lit(first_date).cast("date"))
    if last_date:
        rows = rows.where(F.col("event_date") <= F.lit(last_date).cast("date"))
    span = f"{COMPACTED}-{first_date or 'all'}-{last_date or 'all'}"
    write_batch(rows.drop("writer", "batch_id", "event_date"), target, 0, writer=span)
