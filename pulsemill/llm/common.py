"""What the text operators share: tables, intermediate results, batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.session import scratch_path

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, *used: str) -> DataFrame:
    """All columns but ``used`` under neutral names, by place, so that an operator's own can't clash.

    ``toDF`` with the first names undoes it.
    """
    return df.toDF(*[c if c in used else f"_their_{i}" for i, c in enumerate(df.columns)])


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch hands to a Python worker, also for very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: str | Column) -> Column:
    """Number of words between ASCII white space, 0 for null.

    A word begins where a word character follows the start or white space, so counting
    words is counting separators after collapsing them; no array of words is built.
    """
    spaced = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(spaced) - F.length(F.replace(spaced, F.lit(" ")))
    return F.coalesce(F.when(F.length(spaced) > 0, spaces + 1), F.lit(0)).cast("long")
