"""The streaming job: sources, enrichment, counters, fan-out to the sinks."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemill.operators.counters import ENRICHMENT
from pulsemill.plans import rollups
from pulsemill.session import STATE_SETTINGS, STREAM_SETTINGS, temporary_conf
from pulsemill.sinks import delivery, kv, warehouse
from pulsemill.sinks.folders import glob, own_folder
from pulsemill.sources.changes import (
    CONTENT_TABLE, ENGAGEMENT_TABLE, content_changes, content_changes_and_deletes, engagement_changes,
    for_table, include, parse_content, parse_engagement, quarantined,
)
from pulsemill.streaming import buckets as bucketed
from pulsemill.streaming.enrich import (
    DEFAULT_PENDING_TTL_SECS, GROUPS, KIND_EVENT, KIND_FIRST_SEEN, SHELVES, enrich_stream, enriched_events,
)

log = logging.getLogger(__name__)

DEFAULT_EMIT_SECS = 3


def build_stream(
    engagement_feed: DataFrame,
    content_feed: DataFrame,
    pending_ttl_secs: float = DEFAULT_PENDING_TTL_SECS,
    hot_ids: Collection[str] = (),
    hot_slices: int = 16,
    keep_extras: bool = True,
) -> DataFrame:
    """Two change feeds to enriched output, with outcome counters observed.

    The feeds are separate subscriptions: branches of one source would read it
    once each.  Fields of an event that the schema does not name go along to the
    key-value store and the receiver; a feed without such fields saves a parse
    with ``keep_extras=False``.
    """
    output = enrich_stream(
        engagement_changes(for_table(include(engagement_feed), ENGAGEMENT_TABLE), keep_extras),
        content_changes(for_table(include(content_feed), CONTENT_TABLE)),
        pending_ttl_secs, hot_ids, hot_slices,
    )
    output = with_counters(output)
    output.slice_layout = json.dumps({"groups": [GROUPS, SHELVES], **json.loads(slice_layout(hot_ids, hot_slices))})
    return output


def build_bucket_stream(
    engagement_feed: DataFrame,
    content_feed: DataFrame,
    pending_ttl_secs: float = DEFAULT_PENDING_TTL_SECS,
    hot_ids: Collection[str] = (),
    hot_slices: int = 16,
    buckets: int = bucketed.DEFAULT_BUCKETS,
    deletes: bool = False,
    content_ttl_secs: float | None = None,
    in_order: bool = False,
    initial: DataFrame | None = None,
    keep_extras: bool = True,
) -> DataFrame:
    """The same job on the bucketed state machine; see ``streaming.buckets`` for what it adds.

    With ``deletes`` a delete in the catalogue feed makes its content unknown; without, it is
    ignored as in ``build_stream``.
    """
    catalogue = for_table(include(content_feed), CONTENT_TABLE)
    output = bucketed.enrich_stream(
        engagement_changes(for_table(include(engagement_feed), ENGAGEMENT_TABLE), keep_extras),
        content_changes_and_deletes(catalogue) if deletes else content_changes(catalogue),
        pending_ttl_secs, hot_ids, hot_slices, buckets, content_ttl_secs, in_order, initial,
    )
    output = with_counters(output)
    output.slice_layout = json.dumps({"buckets": buckets, **json.loads(slice_layout(hot_ids, hot_slices))})
    return output


SKETCHED_IDS = 10_000  # ids that a sketch of a batch keeps


def note_frequent_ids(batch: DataFrame, path: str, batch_id: int) -> None:
    """Keep a sketch of the content ids of a batch's events: one bounded row per batch.

    Call it in the sink. A repeated batch replaces its sketch.
    """
    sketch = batch.where(F.col("kind") == KIND_EVENT).agg(
        F.expr(f"approx_top_k_accumulate(content_id, {SKETCHED_IDS})").alias("sketch"),
        F.count("content_id").alias("n"))
    sketch.coalesce(1).write.mode("overwrite").parquet(own_folder(batch.sparkSession, path, batch_id))


def frequent_ids(spark: SparkSession, path: str, share: float = 0.05) -> list[str]:
    """Content ids that hold at least ``share`` of all events noted so far: name them hot at the next start.

    At most 1 / share ids. Sketches may count an id too high by at most a 7,500th of the events.
    """
    noted = spark.read.parquet(path)
    total = noted.agg(F.sum("n")).first()[0] or 0
    k = max(1, min(SKETCHED_IDS, int(2 / share)))
    top = noted.agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {SKETCHED_IDS}), {k})").alias("top"))
    rows = top.select(F.explode("top").alias("t")).where(F.col("t.count") >= share * total).select("t.item").collect()
    return sorted(r.item for r in rows if r.item is not None)


def slice_layout(hot_ids: Collection[str], hot_slices: int) -> str:
    return json.dumps({"hot_ids": sorted(hot_ids), "hot_slices": hot_slices if hot_ids else 0})


def _same_layout(spark: SparkSession, output: DataFrame, checkpoint: str) -> None:
    """Refuse a restart whose hot ids or slices differ from those the state was built with.

    The slices of an id that becomes hot have not seen its content: events would
    leave as missing. A change needs a new checkpoint: one into which the content feed
    is read again from its start, or, in buckets, one that begins with what this knows.
    """
    layout = getattr(output, "slice_layout", None)
    if layout is None:
        return
    path = f"{checkpoint}/slice_layout"
    found = glob(spark, path)
    if not found:
        spark.createDataFrame([(layout,)], "value string").coalesce(1).write.text(path)
        return
    before = spark.read.text(path).first().value
    if before != layout:
        raise ValueError(
            f"the state in {checkpoint} was built with {before}, not {layout}: start a new checkpoint"
            + (", with buckets.carried_over of this one as initial state" if "buckets" in layout else ""))


def with_counters(output: DataFrame) -> DataFrame:
    """Report per batch, in the query progress, what became of events and items.

    ``flushed_pending`` counts items whose first version released waiting events.
    """
    return output.observe(ENRICHMENT, *_outcomes())


def _outcomes() -> list[Column]:
    is_event = F.col("kind") == KIND_EVENT
    is_token = F.col("kind") == KIND_FIRST_SEEN
    return [
        F.count_if(is_event & ~F.col("content_missing")).alias("enriched"),
        F.count_if(is_event & F.col("content_missing")).alias("missing_content"),
        F.count_if(is_token).alias("new_items"),
        F.count_if(is_token & F.col("drained")).alias("flushed_pending"),
    ]


COUNTED = ("enriched", "missing_content", "new_items", "flushed_pending", "rejected", "failed_sinks")
_COUNTS = ", ".join(f"{name} long" for name in COUNTED)


def counter_totals(spark: SparkSession, counters_path: str) -> dict[str, int]:
    """Sum of the counters over all batches that ``FanOut`` has written, of all queries.

    A batch has one folder, so a repeated batch counts once. Before the first batch all are 0.
    """
    if not glob(spark, counters_path):
        return dict.fromkeys(COUNTED, 0)
    kept = spark.read.schema(_COUNTS).json(counters_path)
    row = kept.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTED]).first()
    return row.asDict()


def quarantine_stream(engagement_feed: DataFrame, content_feed: DataFrame) -> DataFrame:
    """Messages of both feeds that have no usable after-image, with the reason."""
    engagement = parse_engagement(for_table(include(engagement_feed), ENGAGEMENT_TABLE))
    content = parse_content(for_table(include(content_feed), CONTENT_TABLE))
    return quarantined(engagement).unionByName(quarantined(content))


def start_quarantine(
    bad: DataFrame, path: str, checkpoint: str, emit_every_secs: float | None = DEFAULT_EMIT_SECS
) -> StreamingQuery:
    """Append bad messages to a folder; without an interval, what is there now, then stop."""
    when = {"availableNow": True} if emit_every_secs is None else {
        "processingTime": f"{int(emit_every_secs * 1000)} milliseconds"}
    return (
        bad.writeStream.format("parquet").outputMode("append").trigger(**when)
        .option("path", path).option("checkpointLocation", checkpoint).start()
    )


@dataclass
class FanOut:
    """One micro-batch to every sink.

    The warehouse must succeed, else the batch is run again.  A failure of the
    key-value store or the receiver is logged and counted, and does not stop the
    others.  Rows without a required column go to ``rejects_path``, the counters of
    every batch to ``counters_path``; both lie beside the table by default.
    """

    warehouse_path: str
    kv_path: str | None = None
    kv_ttl_secs: int | None = kv.DEFAULT_TTL_SECS
    make_kv_client: Callable[[], kv.Client] | None = None
    kv_receipts_path: str | None = None
    rejects_path: str | None = None
    counters_path: str | None = None
    rollup_path: str | None = None
    make_transport: Callable[[], delivery.Transport] | None = None
    receipts_path: str | None = None
    delivery_batch_size: int = delivery.DEFAULT_BATCH_SIZE
    include_missing: bool = False

    def __post_init__(self) -> None:
        if self.make_transport and not self.receipts_path:
            raise ValueError("a transport needs a receipts_path")
        if self.make_kv_client and not self.kv_receipts_path:
            raise ValueError("a key-value client needs a kv_receipts_path")
        self.rejects_path = self.rejects_path or f"{self.warehouse_path}-rejects"
        self.counters_path = self.counters_path or f"{self.warehouse_path}-counters"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Every sink reads the batch; without this the state machine's output
        # would be computed once per sink.
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            events = enriched_events(batch)
            rows, rejects = warehouse.warehouse_rows(events, self.include_missing)
            warehouse.write_batch(rows, self.warehouse_path, batch_id, rebalance=False)
            failed = 0
            rejects.write.mode("overwrite").parquet(own_folder(spark, self.rejects_path, batch_id))
            if self.rollup_path:
                failed += self._optional(
                    "rollup", batch_id, lambda: rollups.write_batch(rows, self.rollup_path, batch_id))
            if self.kv_path:
                failed += self._optional("key-value", batch_id, lambda: kv.write_batch(
                    kv.kv_pairs(events, ["seq", "event_ts"]), self.kv_path, batch_id,
                    ttl_secs=self.kv_ttl_secs,
                ))
            if self.make_kv_client:
                failed += self._optional("key-value client", batch_id, lambda: kv.push(
                    kv.kv_pairs(events, ["seq", "event_ts"]), self.make_kv_client, self.kv_ttl_secs,
                ).write.mode("overwrite").parquet(own_folder(spark, self.kv_receipts_path, batch_id)))
            if self.make_transport:
                failed += self._optional("delivery", batch_id, lambda: delivery.deliver(
                    events, self.make_transport, self.receipts_path, batch_id,
                    self.delivery_batch_size,
                ))
            self._count(batch, rejects, failed, batch_id)
        finally:
            batch.unpersist()

    def _count(self, batch: DataFrame, rejects: DataFrame, failed: int, batch_id: int) -> None:
        counts = batch.agg(*_outcomes()).withColumn("failed_sinks", F.lit(failed)).crossJoin(
            rejects.agg(F.count("*").alias("rejected")))  # one row each
        target = own_folder(batch.sparkSession, self.counters_path, batch_id)
        counts.select(*COUNTED).coalesce(1).write.mode("overwrite").json(target)

    @staticmethod
    def _optional(name: str, batch_id: int, write: Callable[[], None]) -> int:
        """Number of failures."""
        try:
            write()
        except Exception:
            log.exception("%s sink failed for batch %s", name, batch_id)
            return 1
        return 0


def start(
    spark: SparkSession,
    output: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    emit_every_secs: float = DEFAULT_EMIT_SECS,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the job; a restart with the same checkpoint resumes it.

    ``state_partitions`` and the hot ids are fixed by the first start.  No
    watermark is set: in the global window nothing is late.
    """
    _same_layout(spark, output, checkpoint)
    settings = dict(STREAM_SETTINGS)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with temporary_conf(spark, settings):
        return (
            output.writeStream.foreachBatch(sink)
            .outputMode("append")
            .trigger(processingTime=f"{int(emit_every_secs * 1000)} milliseconds")
            .option("checkpointLocation", checkpoint)
            .start()
        )


class Collector:
    """Keep a stream's rows in a folder and count its events: for replays of bounded feeds."""

    def __init__(self, path: str, also: Callable[[DataFrame, int], None] | None = None, idle_secs: float = 300):
        self.path = path
        self.also = also
        self.events = 0
        self._long_secs = idle_secs / 2
        self._worked = time.monotonic()  # end of the last batch that gave rows, or took long
        self._began: float | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._began = began = time.monotonic()
        try:
            target = f"{self.path}/batch_id={batch_id}"
            batch.write.mode("overwrite").parquet(target)
            written = batch.sparkSession.read.schema(batch.schema).parquet(target)
            if self.also:
                self.also(written, batch_id)
            rows, events = written.agg(F.count("*"), F.count_if(F.col("kind") == KIND_EVENT)).first()
            self.events += events
            if rows or time.monotonic() - began > self._long_secs:
                self._worked = time.monotonic()
        finally:
            self._began = None

    def idle_secs(self) -> float:
        """Time without a row; a batch that is running counts as work, however long it takes."""
        began, now = self._began, time.monotonic()
        return (now if began is None else began) - self._worked


def replay(
    spark: SparkSession,
    output: DataFrame,
    n_events: int,
    path: str,
    state_partitions: int | None = None,
    emit_every_secs: float = 0.2,
    idle_secs: float = 300,
    also: Callable[[DataFrame, int], None] | None = None,
) -> DataFrame:
    """Run the stream over a bounded feed until every event has left it.

    With a processing-time wait a stream has no end of its own: the last missing
    events leave when their wait is over. If none leaves for ``idle_secs``, which must be
    longer than a wait and a batch, some are lost: an error. ``also`` gets every batch as kept.
    """
    collector = Collector(f"{path}/out", also, idle_secs)
    query = start(
        spark, output, collector, f"{path}/checkpoint", emit_every_secs, state_partitions
    )
    try:
        while (seen := collector.events) < n_events:
            if collector.idle_secs() > idle_secs:
                raise RuntimeError(f"only {seen} of {n_events} events have left the stream")
            if query.exception() is not None:
                raise query.exception()
            if not query.isActive:
                raise RuntimeError(f"the stream ended with {collector.events} of {n_events} events")
            time.sleep(0.05)
    finally:
        query.stop()
    return spark.read.schema(output.schema).parquet(collector.path)


def final_table(
    spark: SparkSession, running: DataFrame, path: str, state_partitions: int | None = None
) -> DataFrame:
    """Last state of a running aggregate over a bounded feed (complete mode)."""
    settings = dict(STATE_SETTINGS)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out")

    with temporary_conf(spark, settings):
        query = (
            running.writeStream.foreachBatch(keep).outputMode("complete")
            .trigger(availableNow=True)
            .option("checkpointLocation", f"{path}/checkpoint").start()
        )
    query.awaitTermination()
    return spark.read.schema(running.schema).parquet(f"{path}/out")


def start_console(
    spark: SparkSession, output: DataFrame, checkpoint: str, emit_every_secs: float = DEFAULT_EMIT_SECS
) -> StreamingQuery:
    """Debug sink: print enriched events as they are emitted."""
    with temporary_conf(spark, STREAM_SETTINGS):
        return (
            enriched_events(output).writeStream.format("console").option("truncate", "false")
            .outputMode("append")
            .trigger(processingTime=f"{int(emit_every_secs * 1000)} milliseconds")
            .option("checkpointLocation", checkpoint)
            .start()
        )
