"""Folders that one batch of one writer owns in a shared table.

Batch numbers begin at 0 with every checkpoint, so a number alone names nothing: the
writer, a streaming query's id, is part of the path. Writing a batch again replaces what
its first try left, and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_WRITER = "batch"  # writes outside a streaming query


def current_writer(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is being written, else ``batch``.

    The id stays the same over restarts and is new with a new checkpoint.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or BATCH_WRITER


def glob(spark: SparkSession, pattern: str) -> list:
    """Hadoop paths that match, on whatever file system they are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath() for s in files.globStatus(path) or []]


def remove(spark: SparkSession, pattern: str) -> int:
    """Delete the folders a glob names; how many."""
    found = glob(spark, pattern)
    for p in found:
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(found)


def replace_batch(
    rows: DataFrame, path: str, by: list[str], batch_id: int, writer: str | None = None
) -> None:
    """Append a batch below the folders of ``by``, instead of an earlier try of it.

    A failure between removing and writing leaves the batch uncommitted, so it is
    written again.
    """
    spark = rows.sparkSession
    writer = writer or current_writer(spark)
    own = f"writer={writer}/batch_id={int(batch_id)}"
    remove(spark, "/".join([path, *[f"{c}=*" for c in by], own]))
    (
        rows.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .write.mode("append").partitionBy(*by, "writer", "batch_id").parquet(path)
    )


def own_folder(spark: SparkSession, path: str, batch_id: int, writer: str | None = None) -> str:
    """A folder that only this batch writes."""
    return f"{path}/writer={writer or current_writer(spark)}/batch_id={int(batch_id)}"
