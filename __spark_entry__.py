
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles as O  # noqa: E402
from pulsemill.functions.measures import approx_quantiles, on_grid  # noqa: E402
from pulsemill.functions.timefuncs import epoch_seconds  # noqa: E402
from pulsemill.operators import asof, counters, drift, enrich, quality, windows  # noqa: E402
from pulsemill.plans import insights, rollups  # noqa: E402
from pulsemill.plans.feed import enriched_from_feed  # noqa: E402
from pulsemill.schemas import ENRICHED, EVENT_TYPES  # noqa: E402
from pulsemill.session import STATE_SETTINGS, scratch_path, temporary_conf  # noqa: E402
from pulsemill.sinks import delivery, kv, receiver, warehouse  # noqa: E402
from pulsemill.sources import changes, fixtures  # noqa: E402
from pulsemill.sources.tables import content_ids, read_warehouse  # noqa: E402
from pulsemill.streaming import buckets, job  # noqa: E402
from pulsemill.streaming.enrich import enriched_events  # noqa: E402

try:  # the text operators may be left out of an installation
    import corpus_pipeline
    from pulsemill.llm import queries as llm
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "pulsemill.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
QUANTILE_ACCURACY = 1_000_000  # exact on the test data, so it can be compared
STREAM_WAIT_SECS = 1.0


def entry(spark: SparkSession) -> DataFrame:
    """Change messages -> after-images -> enrichment -> mean share by type and device."""
    feed = fixtures.content_feed(spark, SMOKE_DIR).unionByName(
        fixtures.engagement_feed(spark, SMOKE_DIR, mixed=False)
    )
    return insights.type_device_engagement(enriched_from_feed(feed), O.AS_OF)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table, derived from the given tables."""
    return enrich.enrich_snapshot(
        fixtures.engagement(spark, sf_dir), fixtures.content(spark, sf_dir)
    )


def gridded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, on_grid(F.col(c)))
    return df


def _insights() -> dict[str, Query]:
    """The analytics library on the enriched table; doubles on a grid."""
    month = (O.START, O.END)
    plans: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
        "q_engagement_by_content_type": (
            lambda t: insights.engagement_by_content_type(t, O.DAY),
            ("avg_engagement_pct", "avg_engagement_seconds")),
        "q_user_patterns": (
            lambda t: insights.user_engagement_patterns(t, O.AS_OF), ("avg_engagement_pct",)),
        "q_content_performance": (
            lambda t: insights.content_performance(t, O.AS_OF), ("avg_completion_pct",)),
        "q_type_device_avg": (
            lambda t: insights.type_device_engagement(t, O.AS_OF), ("avg_engagement_pct",)),
        "q_p90_by_type": (
            lambda t: insights.p90_seconds_by_type(t, O.AS_OF, accuracy=QUANTILE_ACCURACY), ()),
        "q_top_device": (
            lambda t: insights.top_device(t, O.AS_OF), ("avg_engagement_seconds",)),
        "q_device_stddev": (
            lambda t: insights.device_variability(t, O.AS_OF), ("stddev_engagement_pct",)),
        "q_median_high_engagement": (
            lambda t: insights.median_seconds_of_engaged(t, O.AS_OF, accuracy=QUANTILE_ACCURACY), ()),
        "q_top_ios_content": (
            lambda t: insights.top_content_on_device(t, "ios", O.AS_OF), ("avg_engagement_seconds",)),
        "q_long_content": (
            lambda t: insights.long_content_engagement(t, O.AS_OF), ("avg_engagement_pct",)),
        "q_device_stats": (
            lambda t: insights.device_statistics(t, *month), ("avg_engagement", "stddev_engagement")),
        "q_user_best_content": (
            lambda t: insights.most_engaging_content_per_user(t, *month), ()),
        "q_inconsistent_content": (
            lambda t: insights.inconsistent_content(t, *month), ("engagement_variance",)),
        "q_length_correlation": (
            lambda t: insights.length_correlation(t, O.AS_OF), ("pct_length_correlation",)),
        "q_top5_types_per_device": (
            lambda t: insights.top_types_per_device(t, O.AS_OF), ("avg_engagement_pct",)),
        "q_total_events": (
            lambda t: insights.total_events(t.where(~F.col("content_missing"))), ()),
        "q_recent_events": (
            lambda t: insights.recent_events(
                t.where(~F.col("content_missing")).drop("content_missing")), ()),
        "op_quantile_array": (_quantile_rows, ()),
    }

    def query(plan: Callable[[DataFrame], DataFrame], doubles: tuple[str, ...]) -> Query:
        return lambda spark, sf_dir: gridded(plan(enriched(spark, sf_dir)), *doubles)

    return {name: query(plan, doubles) for name, (plan, doubles) in plans.items()}


def _quantile_rows(table: DataFrame) -> DataFrame:
    quantiles = approx_quantiles("engagement_seconds", 10, QUANTILE_ACCURACY)
    per_type = table.groupBy("content_type").agg(quantiles.alias("q"))
    steps = F.sequence(F.lit(0), F.lit(10))
    return per_type.select("content_type", "q", F.explode(steps).alias("quantile")).select(
        "content_type", "quantile", F.get("q", F.col("quantile")).alias("engagement_seconds")
    )


def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.source_counts(
        fixtures.content(spark, sf_dir), fixtures.engagement(spark, sf_dir)
    )


WRITTEN_AT, READ_AT = "2024-02-01 00:00:00", "2024-02-01 00:30:00"


def _kv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.with_expiry(kv.kv_pairs(enriched(spark, sf_dir)), WRITTEN_AT)


def q_kv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry_ = kv.get(_kv_log(spark, sf_dir), O.LOOKUP_KEY, READ_AT, kv.DEFAULT_TTL_SECS)
    return entry_.select("key", "value")


def q_kv_prefix_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = kv.keys_with_prefix(_kv_log(spark, sf_dir), kv.KEY_PREFIX, READ_AT)
    return keys.agg(F.count("*").alias("n_keys"))


def op_route_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = (
        fixtures.content_feed(spark, sf_dir)
        .unionByName(fixtures.engagement_feed(spark, sf_dir))
        .unionByName(fixtures.foreign_feed(spark, sf_dir))
    )
    return (
        changes.routed(changes.include(feed))
        .groupBy(F.col("table").alias("source_table")).agg(F.count("*").alias("messages"))
    )


def op_snapshot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_ids(fixtures.content(spark, sf_dir))


def _event_list() -> list:
    """Event columns with the instant as microseconds, whatever the session zone is."""
    return [
        "id", "content_id", "user_id", "event_type", F.unix_micros("event_ts").alias("event_us"),
        "duration_ms", "device", "raw_payload",
    ]


def op_unwrap_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.engagement_changes(fixtures.engagement_feed(spark, sf_dir), keep_extras=True)
    return rows.select(*_event_list(), "seq", F.to_json("extras").alias("extras"))


def op_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.quarantined(changes.parse_engagement(fixtures.engagement_feed(spark, sf_dir)))


def op_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = changes.engagement_changes(fixtures.engagement_feed(spark, sf_dir, mixed=False))
    content = changes.content_changes(fixtures.content_feed(spark, sf_dir))
    return events.select(
        F.lit("engagement_events").alias("source_table"),
        F.concat(F.lit("e-"), "id").alias("id"), epoch_seconds(F.col("event_ts")).alias("epoch"),
    ).unionByName(
        content.select(
            F.lit("content").alias("source_table"), "id",
            epoch_seconds(F.col("publish_ts")).alias("epoch"),
        )
    )


def op_enrich_beyond_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join for a catalogue that is too big to broadcast."""
    return enrich.enrich_snapshot(
        fixtures.engagement(spark, sf_dir), fixtures.content(spark, sf_dir),
        broadcast_bytes=0,
    )


def _asof(wait_secs: float | None, sliced: bool) -> Query:
    sizes = {"hot_rows": 200, "slice_rows": 400} if sliced else {}

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = fixtures.with_arrival_time(fixtures.engagement_arrivals(spark, sf_dir))
        versions = fixtures.with_arrival_time(fixtures.content_updates(spark, sf_dir))
        joined = asof.enrich_asof(events, versions, wait_secs, **sizes)
        return joined.drop("seq", "arrival_ts")

    return query


def op_latest_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.latest_per_key(fixtures.content_updates(spark, sf_dir))


def op_union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.tagged_union(
        fixtures.engagement(spark, sf_dir), fixtures.content(spark, sf_dir)
    )


def op_content_cache_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.content_cache_size(fixtures.content_updates(spark, sf_dir))


def op_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.outcome_counts(_asof(O.WAIT_SECS, False)(spark, sf_dir))


def op_required_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = quality.split_required(fixtures.flawed_engagement(spark, sf_dir))
    return rejects.select("id", F.array_join("missing", ",").alias("missing"))


def op_domain_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.flawed_engagement(spark, sf_dir)
    return quality.domain_rejects(rows, {"event_type": EVENT_TYPES}).select("id", "event_type")


def op_fk_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = quality.referential_rejects(
        fixtures.flawed_engagement(spark, sf_dir), fixtures.content(spark, sf_dir)
    )
    return rejects.select("id", "content_id")


def op_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(fixtures.content_updates(spark, sf_dir), "id")


def op_kv_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv.kv_pairs(enriched(spark, sf_dir))


def op_delivery_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.numbered_batches(enriched(spark, sf_dir), "id", O.BATCH_SIZE)


def op_delivery_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send every event to a receiver that accepts all, count what the receipts say."""
    documents = delivery.numbered_batches(enriched(spark, sf_dir), "id", O.BATCH_SIZE)
    return counters.receipt_counts(delivery.send(documents, delivery.DryRun))


def op_delivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send a stream of events through the data source, count what its committed batches say."""
    path = scratch_path(spark, "delivery")
    rows = enrich.enrich_snapshot(fixtures.engagement(spark, sf_dir, stream=True), fixtures.content(spark, sf_dir))
    sink = receiver.register(spark, "pulsemill_receiver", delivery.DryRun, f"{path}/receipts", O.BATCH_SIZE)
    receiver.events(rows).writeStream.format(sink).trigger(availableNow=True).option(
        "checkpointLocation", f"{path}/checkpoint").start().awaitTermination()
    return receiver.receipts(spark, f"{path}/receipts").groupBy("status").agg(F.sum("n_events").alias("events"))


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.engagement_changes(fixtures.drifted_engagement_feed(spark, sf_dir), keep_extras=True)


def op_drift_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields of a drifted feed and the types its values agree on."""
    return drift.discovered_fields(_drifted(spark, sf_dir))


def op_drift_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose first batch knows no promoted fields, and whose second brings them."""
    path = scratch_path(spark, "promoted")
    events = _drifted(spark, sf_dir)
    fields = drift.agreed_schema(drift.discovered_fields(events), ENRICHED)
    rows = enrich.enrich_snapshot(drift.promoted(events, fields).drop("seq"), fixtures.content(spark, sf_dir))
    half = F.col("id") % 2
    before, _ = warehouse.warehouse_rows(rows.where(half == 1), include_missing=True)
    after, _ = warehouse.warehouse_rows(rows.where(half == 0), include_missing=True, promoted=fields.names)
    warehouse.write_batch(before, path, 0)
    warehouse.write_batch(after, path, 1)
    return read_warehouse(spark, path, fields).select(
        "id", "content_id", "app_version", "muted", F.col("volume").cast("double").alias("volume"))


def op_warehouse_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table as a partitioned batch, read it back by date."""
    path = scratch_path(spark, "warehouse")
    rows, _ = warehouse.warehouse_rows(enriched(spark, sf_dir))
    warehouse.write_batch(rows, path, 0)
    table = read_warehouse(spark, path)
    counts = table.groupBy("event_date", "content_type", "event_type").agg(
        F.count("*").alias("n_rows")
    )
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers with the same batch number on one table: nothing is replaced."""
    path = scratch_path(spark, "two_runs")
    rows, _ = warehouse.warehouse_rows(enriched(spark, sf_dir))
    half = F.col("id") % 2
    warehouse.write_batch(rows.where(half == 0), path, 0, writer="first")
    warehouse.write_batch(rows.where(half == 1), path, 0, writer="second")
    warehouse.write_batch(rows.where(half == 1), path, 0, writer="second")  # a repeated batch
    return read_warehouse(spark, path).select("id", "content_id", "event_type", F.unix_micros("event_ts").alias("event_us"))


def _on_written(plan: Callable[[DataFrame], DataFrame], *doubles: str) -> Query:
    """An insight on the written, date-partitioned table."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "written")
        warehouse.write_batch(warehouse.warehouse_rows(enriched(spark, sf_dir))[0], path, 0)
        return gridded(plan(read_warehouse(spark, path)), *doubles)

    return query


def _on_rollup(name: str, plan: Callable[[DataFrame], DataFrame], start: str, end: str, *doubles: str) -> Query:
    """An insight on daily rollups, written by two batches; only the ends come from the events."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "rollups")
        events = enriched(spark, sf_dir)
        for batch in range(2):
            rollups.write_batch(events.where(F.pmod(F.xxhash64("id"), F.lit(2)) == batch), path, batch)
        rows = rollups.over_range(rollups.read(spark, path, name), events, name, start, end)
        return gridded(plan(rows), *doubles)

    return query


def q_kv_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live keys of a log in which a third has expired, a third is live, a third lasts."""
    path = scratch_path(spark, "kv")
    pairs = kv.kv_pairs(enriched(spark, sf_dir)).withColumn(
        "part", F.substring_index("key", ":", -1).cast("long") % 3)
    for part, (written, ttl) in enumerate(
            (("2024-01-31 12:00:00", 3_600), (WRITTEN_AT, 3_600), ("2024-01-02 00:00:00", None))):
        kv.write_batch(pairs.where(F.col("part") == part).drop("part"), path, part, written, ttl)
    return kv.live_entries(kv.read_log(spark, path), READ_AT, kv.DEFAULT_TTL_SECS).select("key")


def op_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        fixtures.flawed_engagement(spark, sf_dir), fixtures.content(spark, sf_dir), {"event_type": EVENT_TYPES})


def op_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad messages of both feeds, kept by their own stream."""
    path = scratch_path(spark, "quarantine")
    bad = job.quarantine_stream(
        fixtures.engagement_feed(spark, sf_dir, stream=True), fixtures.content_feed(spark, sf_dir, stream=True))
    job.start_quarantine(bad, f"{path}/bad", f"{path}/checkpoint", None).awaitTermination()
    return spark.read.schema(bad.schema).parquet(f"{path}/bad")


def op_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.tumbling_counts(fixtures.engagement(spark, sf_dir), "6 hours", None, "event_type")
    return counts.select(epoch_seconds(F.col("window_start").cast("timestamp")).alias("window_epoch"), "event_type", "n_events")


def op_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event comes twice, the copy later and changed."""
    rows = fixtures.engagement_arrivals(spark, sf_dir)
    again = rows.where(F.col("id") % 3 == 0).withColumn("seq", F.col("seq") + 1).withColumn("device", F.lit("copy"))
    return windows.dedup_events(rows.unionByName(again)).select("id", "device", "seq")


def _stream(hot_ids: tuple[str, ...]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        output = job.build_stream(
            fixtures.engagement_feed(spark, sf_dir, mixed=False, stream=True),
            fixtures.content_feed(spark, sf_dir, stream=True),
            STREAM_WAIT_SECS, hot_ids, hot_slices=4,
        )
        result = job.replay(
            spark, output, fixtures.engagement(spark, sf_dir).count(),
            scratch_path(spark, "stream"),
            state_partitions=spark.sparkContext.defaultParallelism,
        )
        return enriched_events(result).select(
            *_event_list(), "content_type", "length_seconds", "engagement_seconds",
            "engagement_pct", "content_missing",
        )

    return query


def _asof_changed(versions: Callable[[SparkSession, str], DataFrame], ttl_secs: float | None, sliced: bool) -> Query:
    sizes = {"hot_rows": 200, "slice_rows": 400} if sliced else {}

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = fixtures.with_arrival_time(fixtures.engagement_arrivals(spark, sf_dir))
        rows = fixtures.with_arrival_time(versions(spark, sf_dir))
        joined = asof.enrich_asof(events, rows, content_ttl_secs=ttl_secs, **sizes)
        return joined.drop("seq", "arrival_ts")

    return query


BUCKETS = 256


def _bucket_replay(spark: SparkSession, sf_dir: str, content: DataFrame, **options) -> tuple[DataFrame, str]:
    """The bucketed stream over all events, and its checkpoint."""
    output = job.build_bucket_stream(
        fixtures.engagement_feed(spark, sf_dir, mixed=False, stream=True), content, STREAM_WAIT_SECS,
        hot_slices=4, buckets=BUCKETS, **options)
    path = scratch_path(spark, "stream")
    result = job.replay(
        spark, output, fixtures.engagement(spark, sf_dir).count(), path,
        state_partitions=spark.sparkContext.defaultParallelism)
    return enriched_events(result), f"{path}/checkpoint"


_ENRICHED_LIST = ["content_type", "length_seconds", "engagement_seconds", "engagement_pct", "content_missing"]


def op_stream_enrich_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _bucket_replay(spark, sf_dir, fixtures.content_feed(spark, sf_dir, stream=True), hot_ids=("c-3",))
    return rows.select(*_event_list(), *_ENRICHED_LIST)


def op_stream_enrich_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates, deletes and events by their common arrival numbers: the as-of join's answer."""
    rows, _ = _bucket_replay(
        spark, sf_dir, fixtures.content_change_feed(spark, sf_dir, stream=True), deletes=True, in_order=True)
    return rows.select(*_event_list(), *_ENRICHED_LIST, "drained")


def op_stream_initial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint that begins with the catalogue snapshot and a hot id; the feed brings no content."""
    snapshot = buckets.tagged_rows(None, fixtures.content(spark, sf_dir), ("c-3",), 4, BUCKETS)
    silent = fixtures.content_feed(spark, sf_dir, stream=True).where(F.lit(False))
    rows, _ = _bucket_replay(spark, sf_dir, silent, hot_ids=("c-3",), initial=snapshot)
    return rows.select(*_event_list(), *_ENRICHED_LIST)


def op_state_known_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checkpoint of a finished run knows of the catalogue."""
    _, checkpoint = _bucket_replay(spark, sf_dir, fixtures.content_feed(spark, sf_dir, stream=True), hot_ids=("c-3",))
    with temporary_conf(spark, STATE_SETTINGS):
        return buckets.known_content(spark, checkpoint).drop("seq")


def op_stream_hot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that a job without hot ids finds frequent, batch by batch."""
    path = scratch_path(spark, "frequent")
    output = job.build_bucket_stream(
        fixtures.engagement_feed(spark, sf_dir, mixed=False, stream=True),
        fixtures.content_feed(spark, sf_dir, stream=True), STREAM_WAIT_SECS, buckets=BUCKETS)
    job.replay(
        spark, output, fixtures.engagement(spark, sf_dir).count(), scratch_path(spark, "stream"),
        state_partitions=spark.sparkContext.defaultParallelism,
        also=lambda batch, batch_id: job.note_frequent_ids(batch, path, batch_id))
    return spark.createDataFrame([(i,) for i in job.frequent_ids(spark, path, O.HOT_SHARE)], "content_id string")


def op_stream_cache_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running number of known items, its last value."""
    items = changes.content_changes(fixtures.content_feed(spark, sf_dir, stream=True))
    return job.final_table(
        spark, counters.content_cache_size(items), scratch_path(spark, "cache"),
        state_partitions=spark.sparkContext.defaultParallelism,
    )


def queries() -> dict[str, Query]:
    return {
        **_insights(),
        "q_source_counts": q_source_counts,
        "q_kv_lookup": q_kv_lookup,
        "q_kv_prefix_count": q_kv_prefix_count,
        "op_route_changes": op_route_changes,
        "op_snapshot_ids": op_snapshot_ids,
        "op_unwrap_changes": op_unwrap_changes,
        "op_quarantine": op_quarantine,
        "op_event_time": op_event_time,
        "op_enrich_snapshot": enriched,
        "op_enrich_beyond_broadcast": op_enrich_beyond_broadcast,
        "op_enrich_asof": _asof(None, False),
        "op_enrich_asof_sliced": _asof(None, True),
        "op_enrich_asof_wait": _asof(O.WAIT_SECS, False),
        "op_enrich_asof_wait_sliced": _asof(O.WAIT_SECS, True),
        "op_latest_content": op_latest_content,
        "op_union_tagged": op_union_tagged,
        "op_content_cache_size": op_content_cache_size,
        "op_counters": op_counters,
        "op_required_rejects": op_required_rejects,
        "op_domain_rejects": op_domain_rejects,
        "op_fk_rejects": op_fk_rejects,
        "op_key_duplicates": op_key_duplicates,
        "op_kv_projection": op_kv_projection,
        "op_delivery_batches": op_delivery_batches,
        "op_delivery_receipts": op_delivery_receipts,
        "op_delivery_stream": op_delivery_stream,
        "op_drift_fields": op_drift_fields,
        "op_drift_promoted": op_drift_promoted,
        "op_warehouse_layout": op_warehouse_layout,
        "op_stream_enrich": _stream(()),
        "op_stream_enrich_sliced": _stream(("c-3",)),
        "op_stream_cache_size": op_stream_cache_size,
        "op_enrich_asof_deletes": _asof_changed(fixtures.content_updates_and_deletes, None, False),
        "op_enrich_asof_deletes_sliced": _asof_changed(fixtures.content_updates_and_deletes, None, True),
        "op_enrich_asof_ttl": _asof_changed(fixtures.content_updates, O.CONTENT_TTL_SECS, False),
        "op_enrich_asof_ttl_sliced": _asof_changed(fixtures.content_updates, O.CONTENT_TTL_SECS, True),
        "op_stream_enrich_buckets": op_stream_enrich_buckets,
        "op_stream_enrich_deletes": op_stream_enrich_deletes,
        "op_stream_initial_state": op_stream_initial_state,
        "op_state_known_content": op_state_known_content,
        "op_stream_hot_ids": op_stream_hot_ids,
        "op_warehouse_two_runs": _two_runs,
        "q_engagement_by_content_type_warehouse": _on_written(
            lambda t: insights.engagement_by_content_type(t, O.DAY),
            "avg_engagement_pct", "avg_engagement_seconds"),
        "q_content_performance_warehouse": _on_written(
            lambda t: insights.content_performance(t, O.AS_OF), "avg_completion_pct"),
        "q_type_device_avg_warehouse": _on_written(
            lambda t: insights.type_device_engagement(t, O.AS_OF), "avg_engagement_pct"),
        "q_device_stats_warehouse": _on_written(
            lambda t: insights.device_statistics(t, O.START, O.END), "avg_engagement", "stddev_engagement"),
        "q_type_device_avg_rollup": _on_rollup(
            rollups.TYPE_DEVICE, rollups.type_device_engagement, O.WEEK_START, O.AS_OF, "avg_engagement_pct"),
        "q_device_stddev_rollup": _on_rollup(
            rollups.TYPE_DEVICE, rollups.device_variability, O.START, O.AS_OF, "stddev_engagement_pct"),
        "q_device_stats_rollup": _on_rollup(
            rollups.TYPE_DEVICE, rollups.device_statistics, O.START, O.END, "avg_engagement", "stddev_engagement"),
        "q_length_correlation_rollup": _on_rollup(
            rollups.TYPE_DEVICE, rollups.length_correlation, O.WEEK_START, O.AS_OF, "pct_length_correlation"),
        "q_inconsistent_content_rollup": _on_rollup(
            rollups.CONTENT, rollups.inconsistent_content, O.START, O.END, "engagement_variance"),
        "q_user_patterns_rollup": _on_rollup(
            rollups.USER_PLAYS, rollups.user_engagement_patterns, O.WEEK_START, O.LATER, "avg_engagement_pct"),
        "q_kv_expired": q_kv_expired,
        "op_quality_report": op_quality_report,
        "op_stream_quarantine": op_stream_quarantine,
        "op_tumbling_counts": op_tumbling_counts,
        "op_dedup_events": op_dedup_events,
        **_text_queries(),
    }


def _text_queries() -> dict[str, Query]:
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}


def oracle_sql() -> dict[str, str]:
    text = dict(llm.ORACLES) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        text["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**O.oracle_sql(), **text}
