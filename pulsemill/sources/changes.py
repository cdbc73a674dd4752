"""Change feeds as (topic, value, seq, arrival_ts) frames, streaming or batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from pulsemill.functions import envelopes as E
from pulsemill.functions.keys import last_name_part
from pulsemill.functions.timefuncs import parse_instant
from pulsemill.schemas import CONTENT, ENGAGEMENT

# Topic names of the capture process.
TOPIC_PREFIX = "pgcdc"
CONTENT_TABLE = "content"
ENGAGEMENT_TABLE = "engagement_events"
OFFSET_POSITION = "offset"

FEED = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
])


def topic_pattern(schema: str = "public", table: str = ".*") -> str:
    """Regular expression of the topics of included schemas and tables."""
    return rf"^{TOPIC_PREFIX}\.{schema}\.{table}$"


def kafka_options(servers: str, pattern: str | None = None, **options: str) -> dict[str, str]:
    """Options of a subscription to every included topic.

    ``maxOffsetsPerTrigger`` (pass it in ``options``) bounds a micro-batch after
    an outage; offsets live in the query's checkpoint, so a restart resumes.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": pattern or topic_pattern(),
        "startingOffsets": "earliest",
        **options,
    }


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return kafka_feed(spark.readStream.format("kafka").options(**options).load())


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Batch twin: everything the topics hold now."""
    return kafka_feed(spark.read.format("kafka").options(**options).load())


def kafka_feed(raw: DataFrame, position: str = OFFSET_POSITION) -> DataFrame:
    """Kafka rows to the feed columns; the broker's timestamp is the arrival time.

    ``seq`` is the broker's offset unless ``position`` names a field of the message. The
    changes of an id share a partition, so offsets order its versions.
    """
    value = F.col("value").cast("string")
    seq = F.col("offset") if position == OFFSET_POSITION else E.feed_position(value, position)
    return raw.select(
        "topic",
        value.alias("value"),
        seq.alias("seq"),
        F.col("timestamp").alias("arrival_ts"),
    )


def read_file_stream(
    spark: SparkSession, path: str, topic: str, max_files: int | None = None
) -> DataFrame:
    """One JSON envelope per line, new files picked up as they appear."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return file_feed(reader.load(path), topic)


def read_files(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return file_feed(spark.read.text(path), topic)


def file_feed(lines: DataFrame, topic: str, position: str = E.LOG_POSITION) -> DataFrame:
    value = F.col("value")
    return lines.select(
        F.lit(topic).alias("topic"), value, E.feed_position(value, position).alias("seq"),
        F.current_timestamp().alias("arrival_ts"),
    )


def include(feed: DataFrame, pattern: str | None = None) -> DataFrame:
    """Keep the topics of included schemas and tables."""
    return feed.where(F.col("topic").rlike(pattern or topic_pattern()))


def routed(feed: DataFrame) -> DataFrame:
    """Name the table a message belongs to: the last part of its topic."""
    return feed.withColumn("table", last_name_part(F.col("topic")))


def for_table(feed: DataFrame, table: str) -> DataFrame:
    return feed.where(last_name_part(F.col("topic")) == table)


def _parsed(
    feed: DataFrame, schema: T.StructType, keep_extras: bool, usable_row: Callable[[str], Column]
) -> DataFrame:
    """Typed fields of every message and a ``reason`` where it is unusable.

    ``usable_row`` says, for the parsed struct, whether it has what the feed needs.
    """
    df = E.with_after_image(feed).withColumn("row", E.typed_row(F.col("after"), schema))
    reason = F.when(F.col("reason").isNull() & ~usable_row("row"), E.BAD_ROW).otherwise(F.col("reason"))
    columns = {"reason": reason}
    if keep_extras:
        columns["extras"] = E.extra_fields(F.col("after"), schema)
    columns |= E.typed_fields("row", schema)
    kept = [c for c in ("value", "seq", "arrival_ts") if c in feed.columns]
    return E.evaluated_once(df, kept, **columns)


def parse_engagement(feed: DataFrame, keep_extras: bool = False) -> DataFrame:
    """The engagement feed; a row needs an id and a readable event time."""
    def complete(row: str) -> Column:
        return F.col(f"{row}.id").isNotNull() & parse_instant(F.col(f"{row}.event_ts")).isNotNull()

    return _parsed(feed, ENGAGEMENT, keep_extras, complete)


def parse_content(feed: DataFrame, keep_extras: bool = False) -> DataFrame:
    """The catalogue feed; a row needs an id and gets a default publish time."""
    df = _parsed(feed, CONTENT, keep_extras, lambda row: F.col(f"{row}.id").isNotNull())
    default = parse_instant(F.lit(E.DEFAULT_PUBLISH_TS))
    return df.withColumn("publish_ts", F.coalesce(F.col("publish_ts"), default))


def usable(parsed: DataFrame) -> DataFrame:
    """Typed rows that go on into the pipeline."""
    return parsed.where(F.col("reason").isNull()).drop("reason", "value")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Messages without a usable after-image, as they came, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("reason", "value")


def engagement_changes(feed: DataFrame, keep_extras: bool = False) -> DataFrame:
    return usable(parse_engagement(feed, keep_extras))


def content_changes(feed: DataFrame, keep_extras: bool = False) -> DataFrame:
    return usable(parse_content(feed, keep_extras))


def content_changes_and_deletes(feed: DataFrame) -> DataFrame:
    """The catalogue feed with its deletes: ``deleted`` rows have the id of the before-image.

    A delete that names no id says nothing, and is left out like other unusable messages.
    """
    parsed = parse_content(feed)
    gone = F.coalesce(F.col("reason") == E.DELETE, F.lit(False))
    before = F.coalesce(*[F.get_json_object("value", path) for path in ("$.before.id", "$.payload.before.id")])
    return (
        parsed.withColumn("deleted", gone).withColumn("id", F.when(gone, before).otherwise(F.col("id")))
        .where((F.col("reason").isNull() | gone) & F.col("id").isNotNull()).drop("reason", "value")
    )
