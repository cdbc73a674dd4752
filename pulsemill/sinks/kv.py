"""Key-value projection with expiry, kept as a log of writes.

Every batch appends its writes; nothing is rewritten.  A read takes the newest
write of a key and then looks whether it has expired, which is what an upsert
with time to live does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from pulsemill.functions.keys import KEY_PREFIX, event_json, event_key
from pulsemill.functions.timefuncs import Instant, instant, utc_date, utc_day
from pulsemill.sinks.folders import remove, replace_batch

# Fixed value: lifetime of an entry.
DEFAULT_TTL_SECS = 3_600
BUCKETS = 32

LOG = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
    T.StructField("expires_at", T.TimestampType()),
    T.StructField("lasting", T.BooleanType()),
    T.StructField("written_date", T.DateType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def kv_pairs(enriched: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Newest (key, value) per event; ``order`` says which copy is newest."""
    rows = enriched.select(
        event_key(F.col("content_id"), F.col("id")).alias("key"),
        event_json(enriched).alias("value"),
        F.struct(*[F.col(c) for c in order or ["event_ts"]]).alias("version"),
    )
    newest = F.max_by("value", F.struct("version", "value"))
    return rows.groupBy("key").agg(newest.alias("value"))


def with_expiry(
    pairs: DataFrame, written_at: Instant = None, ttl_secs: int | None = DEFAULT_TTL_SECS
) -> DataFrame:
    """Add ``written_at`` and ``expires_at``; no time to live means no expiry."""
    pairs = pairs.withColumn("written_at", instant(written_at, T.TimestampType()))
    if not ttl_secs:
        return pairs.withColumn("expires_at", F.lit(None).cast("timestamp"))
    return pairs.withColumn(
        "expires_at", F.col("written_at") + F.expr(f"INTERVAL {int(ttl_secs)} SECOND")
    )


def write_batch(
    pairs: DataFrame,
    path: str,
    batch_id: int,
    written_at: Instant = None,
    ttl_secs: int | None = DEFAULT_TTL_SECS,
    writer: str | None = None,
) -> None:
    """Log the writes of one batch; a repeated batch replaces itself.

    Folders: whether the entries last, the UTC date of the write, a bucket of the key.
    """
    rows = with_expiry(pairs, written_at, ttl_secs)
    rows = (
        rows.withColumn("lasting", F.col("expires_at").isNull())
        .withColumn("written_date", utc_date(rows, "written_at"))
        .withColumn("bucket", key_bucket(F.col("key")))
    )
    by = ["lasting", "written_date", "bucket"]
    replace_batch(rows.sortWithinPartitions(*by, "key"), path, by, batch_id, writer)


def key_bucket(key: Column) -> Column:
    """The folder of a key, so that a get reads one in ``BUCKETS`` of the window."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def purge(spark: SparkSession, path: str, before: str, longest_ttl_secs: int = DEFAULT_TTL_SECS) -> int:
    """Delete whole days of writes that had all expired by the UTC date ``before``.

    Entries without expiry stay. Returns the number of days.
    """
    last = dt.date.fromisoformat(before) - dt.timedelta(days=1 + -(-longest_ttl_secs // 86_400))
    days = spark.read.schema(LOG).parquet(path).where(
        ~F.col("lasting") & (F.col("written_date") <= F.lit(last))
    ).select("written_date").distinct().collect()
    return sum(remove(spark, f"{path}/lasting=false/written_date={r.written_date}") for r in days)


class Client(Protocol):
    """What a task needs to reach an external store."""

    def set(self, key: str, value: str, ttl_secs: int | None) -> None: ...

    def close(self) -> None: ...


def push(
    pairs: DataFrame,
    make_client: Callable[[], Client],
    ttl_secs: int | None = DEFAULT_TTL_SECS,
    sink: str = "kv",
) -> DataFrame:
    """Write pairs to an external store and return receipts: counts by outcome.

    A task opens one client and writes its own rows.  A failing write is counted
    and the next one is tried.  Writing happens when the receipts are computed.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        try:
            for frame in frames:
                counts = {"ok": 0, "error": 0}
                for key, value in zip(frame["key"], frame["value"]):
                    try:
                        client.set(key, value, ttl_secs or None)
                        counts["ok"] += 1
                    except Exception:  # one bad write must not stop the rest
                        counts["error"] += 1
                yield pd.DataFrame({
                    "sink": sink, "status": list(counts), "n_events": list(counts.values()),
                })
        finally:
            client.close()

    written = pairs.select("key", "value").mapInPandas(run, "sink string, status string, n_events long")
    return written.where(F.col("n_events") > 0)


def live_entries(
    log: DataFrame, as_of: Instant = None, longest_ttl_secs: int | None = None
) -> DataFrame:
    """Entries (key, value, expires_at) a store would hold at ``as_of``.

    If every expiring write has a time to live of at most ``longest_ttl_secs``,
    older ones cannot be alive and their folders are not read. Entries without
    expiry are read whatever their age.
    """
    return _live(log, ["value"], as_of, longest_ttl_secs)


def _live(
    log: DataFrame, columns: list[str], as_of: Instant, longest_ttl_secs: int | None
) -> DataFrame:
    now = instant(as_of, log.schema["written_at"].dataType)
    seen = log.where(F.col("written_at") <= now)
    if longest_ttl_secs:
        oldest = now - F.expr(f"INTERVAL {int(longest_ttl_secs)} SECOND")
        seen = seen.where((F.col("written_at") >= oldest) | F.col("expires_at").isNull())
        if "written_date" in log.columns:
            day = utc_day(oldest, log.schema["written_at"].dataType)
            seen = seen.where((F.col("written_date") >= day) | F.col("lasting"))
    order = ["written_at", *[c for c in ("batch_id", "writer") if c in log.columns]]
    columns = [*columns, "expires_at"]
    newest = seen.groupBy("key").agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("entry")
    )
    alive = F.col("entry.expires_at").isNull() | (F.col("entry.expires_at") > now)
    return newest.where(alive).select("key", *[F.col(f"entry.{c}") for c in columns])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path)


def get(log: DataFrame, key: str, as_of: Instant = None, longest_ttl_secs: int | None = None) -> DataFrame:
    """One entry; the key filter reaches the scan, its bucket prunes folders."""
    if "bucket" in log.columns:
        log = log.where(F.col("bucket") == key_bucket(F.lit(key)))
    return live_entries(log.where(F.col("key") == key), as_of, longest_ttl_secs)


def keys_with_prefix(
    log: DataFrame, prefix: str = KEY_PREFIX, as_of: Instant = None, longest_ttl_secs: int | None = None
) -> DataFrame:
    matching = log.where(F.col("key").startswith(prefix))
    return _live(matching, [], as_of, longest_ttl_secs).select("key")


def size(log: DataFrame, as_of: Instant = None, longest_ttl_secs: int | None = None) -> DataFrame:
    """Number of live keys; values are not read."""
    return _live(log, [], as_of, longest_ttl_secs).agg(F.count("*").alias("n_keys"))
