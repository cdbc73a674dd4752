import random

from pyspark.sql import functions as F

from pulsemill.operators.enrich import enrich_snapshot, latest_per_key, tagged_union
from pulsemill.operators.skew import fits_broadcast, hot_keys, lookup_join
from pulsemill.plans.feed import enriched_from_feed

EVENT = (
    "id long, content_id string, user_id string, event_type string, event_ts timestamp, "
    "duration_ms long, device string, raw_payload string"
)
CONTENT = "id string, content_type string, length_seconds long"


def events(spark, rows):
    """rows of (id, content_id, duration_ms)"""
    df = spark.createDataFrame(rows, "id long, content_id string, duration_ms long")
    return df.select(
        "id", "content_id", F.lit("u").alias("user_id"), F.lit("play").alias("event_type"),
        F.expr("timestamp '2024-01-15 10:30:00'").alias("event_ts"), "duration_ms",
        F.lit("ios").alias("device"), F.lit("{}").alias("raw_payload"),
    )


def test_worked_example(spark):
    content = spark.createDataFrame([("c", "podcast", 3600)], CONTENT)
    row = enrich_snapshot(events(spark, [(123, "c", 45_000)]), content).first()
    assert (row.content_type, row.length_seconds) == ("podcast", 3600)
    assert (row.engagement_seconds, row.engagement_pct, row.content_missing) == (45.0, 1.25, False)


def test_missing_content_has_no_derived_fields(spark):
    content = spark.createDataFrame([("c", "podcast", 3600)], CONTENT)
    for row in enrich_snapshot(events(spark, [(1, "x", 45_000), (2, None, 45_000)]), content).collect():
        assert row.content_missing
        assert row.engagement_seconds is None and row.engagement_pct is None
        assert row.duration_ms == 45_000


def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        key = ("hot", None, "gone", f"c{rng.randrange(200)}")[min(i % 5, 3)]
        rows.append((i, key, rng.randrange(100_000)))
    content = [("hot", "video", 100)] + [(f"c{k}", "podcast", k) for k in range(150)]
    return events(spark, rows), spark.createDataFrame(content, CONTENT)


def test_both_join_ways_agree_on_skewed_keys(spark):
    facts, content = skewed(spark)
    small = enrich_snapshot(facts, content)
    big = enrich_snapshot(facts, content, broadcast_bytes=0)
    assert small.count() == big.count() == 3_000
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0


def test_beyond_the_limit_one_shuffle_join_reads_the_facts_once(spark, tmp_path):
    facts, content = skewed(spark)
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    joined = lookup_join(facts, content, "content_id", "id", ["content_type"], broadcast_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in plan
    assert plan.count("FileScan parquet") == 1
    assert joined.count() == 3_000
    # facts without a key are dealt out by their hash, not all to one partition
    keyless = facts.where("content_id is null")
    moved = lookup_join(keyless, content, "content_id", "id", [], broadcast_bytes=0)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = moved.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 600


def test_broadcast_only_within_the_limit(spark):
    content = spark.range(1000)
    assert fits_broadcast(content, 10**6) and not fits_broadcast(content, 100)


def test_all_hot_keys_are_found(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("k"))
    assert hot_keys(df, "k", min_rows=50).count() == 10
    assert hot_keys(df, "k", min_rows=100).count() == 0


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "id string, seq long, content_type string")
    got = {r.id: (r.seq, r.content_type) for r in latest_per_key(df).collect()}
    assert got == {"a": (3, "z"), "b": (1, None)}


def test_union_keeps_every_row_and_its_tag(spark):
    facts, content = skewed(spark)
    counts = {r.tag: r["count"] for r in tagged_union(facts, content).groupBy("tag").count().collect()}
    assert counts == {"main": 3_000, "content": content.count()}


def test_feed_to_enriched(spark):
    content = '{"after":{"id":"c","slug":"s","title":"t","content_type":"%s","length_seconds":3600},"ts_ms":%d}'
    event = (
        '{"after":{"id":%d,"content_id":"%s","event_ts":"2024-01-15T10:30:00Z","duration_ms":45000}}'
    )
    rows = [
        ("pgcdc.public.content", content % ("video", 1), 1),
        ("pgcdc.public.content", content % ("podcast", 2), 2),
        ("pgcdc.public.content", '{"before":{"id":"c"},"after":null}', 3),
        ("pgcdc.public.engagement_events", event % (1, "c"), 4),
        ("pgcdc.public.engagement_events", event % (2, "d"), 5),
        ("pgcdc.other.engagement_events", event % (3, "c"), 6),
    ]
    feed = spark.createDataFrame(rows, "topic string, value string, seq long")
    got = {r.id: (r.content_type, r.engagement_pct, r.content_missing) for r in enriched_from_feed(feed).collect()}
    assert got == {1: ("podcast", 1.25, False), 2: (None, None, True)}
