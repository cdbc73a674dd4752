"""Session settings the jobs are designed for."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLUSTER_SETTINGS = {
    # UTC instants everywhere: DATE(event_ts) is a UTC date.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed
    # join partitions and turns a join into a broadcast one once the real size
    # of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # transformWithState needs RocksDB; changelog checkpoints keep the commit
    # of a large state proportional to what changed in the batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

STATE_SETTINGS = {k: v for k, v in CLUSTER_SETTINGS.items() if ".stateStore." in k}

# The streams sort each partition of a micro-batch before the state machine. Spark's check takes
# any sort for a global one over the whole stream.
STREAM_SETTINGS = {**STATE_SETTINGS, "spark.sql.streaming.unsupportedOperationCheck": "false"}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings above to a session builder."""
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


@contextlib.contextmanager
def temporary_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set runtime options for one block and restore the earlier values.

    A streaming query copies the session when it starts, so options that are
    set around ``start()`` belong to that query alone.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset
    (local tests) a temporary folder stands in for it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="pulsemill-")
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write an intermediate result to a scratch path and read it: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
