"""Catalogue, events and feeds derived from the given test tables.

Whole tables, no subsets.  A third of all events and a third of all catalogue
updates fall on one content id, so every query also runs against a hot key.
Ids, sequence numbers and lengths are arithmetic on the given columns, so the
same rows can be written down in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.schemas import CONTENT_TYPES

HOT_KEY = 3
DEVICES = ("ios", "android", "tv", "tablet", "browser", "console")
KINDS = CONTENT_TYPES
SHAPES = 11  # envelope shapes, see ``engagement_feed``

# The columns in use.  A given schema saves looking at the files while planning.
_COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "supplier": "s_suppkey bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    path, columns = f"{sf_dir}/{name}.parquet", _COLUMNS[name]
    if stream:
        # A stream reads folders or patterns, and a table may be one file.
        return spark.readStream.schema(columns).parquet(path + "*")
    return spark.read.schema(columns).parquet(path)


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _content_id(key: Column) -> Column:
    return F.concat(F.lit("c-"), key.cast("string"))


def _kind(key: Column) -> Column:
    return _pick(key % 3, KINDS)


def _length(key: Column, minutes: Column) -> Column:
    """Newsletters have no length; every fiftieth item has length zero."""
    return (
        F.when(key % 3 == 1, F.lit(None))
        .when(key % 50 == 0, F.lit(0))
        .otherwise(60 * minutes + key % 7)
        .cast("bigint")
    )


def content(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Catalogue snapshot: one item per part."""
    part = _table(spark, sf_dir, "part", stream)
    key = F.col("p_partkey")
    return part.select(
        _content_id(key).alias("id"),
        F.concat(F.lit("slug-"), key.cast("string")).alias("slug"),
        F.col("p_name").alias("title"),
        _kind(key).alias("content_type"),
        _length(key, F.col("p_size")).alias("length_seconds"),
        F.expr(
            "timestamp_ntz '2023-12-01 00:00:00' + make_dt_interval(0, cast(p_partkey % 600 as int))"
        ).alias("publish_ts"),
    )


def content_updates(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Catalogue change feed: each part once, each order as an update of an item.

    ``seq`` is unique; its range is that of the events' ``seq``.
    """
    part = _table(spark, sf_dir, "part", stream)
    orders = _table(spark, sf_dir, "orders", stream)
    key = F.col("p_partkey")
    first = part.select(
        _content_id(key).alias("id"), (key * 4 + 1).alias("seq"),
        _kind(key).alias("content_type"), _length(key, F.col("p_size")).alias("length_seconds"),
    )
    order = F.col("o_orderkey")
    key = F.when(order % 3 == 0, F.lit(HOT_KEY).cast("bigint")).otherwise(F.col("o_custkey"))
    later = orders.select(
        _content_id(key).alias("id"), (order * 2).alias("seq"),
        _kind(key).alias("content_type"), _length(key, order % 50 + 1).alias("length_seconds"),
    )
    return first.unionByName(later)


def content_updates_and_deletes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The change feed in which every twenty-second order also deletes its item, a little later."""
    orders = _table(spark, sf_dir, "orders", stream)
    order = F.col("o_orderkey")
    key = F.when(order % 3 == 0, F.lit(HOT_KEY).cast("bigint")).otherwise(F.col("o_custkey"))
    gone = orders.where(order % 22 == 0).select(
        _content_id(key).alias("id"), (order * 2 + 3).alias("seq"), F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("bigint").alias("length_seconds"), F.lit(True).alias("deleted"))
    return content_updates(spark, sf_dir, stream).withColumn("deleted", F.lit(False)).unionByName(gone)


def content_change_feed(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Those updates and deletes as messages; a delete has only a before-image."""
    rows = content_updates_and_deletes(spark, sf_dir, stream)
    image = F.to_json(F.struct("id", "content_type", "length_seconds"))
    before = F.concat(F.lit('{"before":{"id":"'), "id", F.lit('"},"after":null,"op":"d"}'))
    after = F.concat(F.lit('{"before":null,"after":'), image, F.lit(',"op":"u"}'))
    return rows.select(
        F.lit("pgcdc.public.content").alias("topic"), F.when(F.col("deleted"), before).otherwise(after).alias("value"), "seq")


def engagement(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """One engagement per event; some point at items the catalogue lacks."""
    number, user = F.col("event_id"), F.col("user_id")
    key = F.when(number % 3 == 0, F.lit(HOT_KEY).cast("bigint")).otherwise(
        user * 15 + (number % 3 - 1) * (number % 7)
    )
    kind = F.col("event_type")
    return _table(spark, sf_dir, "events", stream).select(
        number.alias("id"),
        _content_id(key).alias("content_id"),
        F.concat(F.lit("u-"), user.cast("string")).alias("user_id"),
        F.when(kind == "signup", "pause").when(kind == "purchase", "finish")
        .when(kind == "click", "click").otherwise("play").alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.when(
            kind.isin("view", "signup", "error"), F.floor(F.col("value") * 1000).cast("bigint")
        ).alias("duration_ms"),
        _pick((number + user) % 6, DEVICES).alias("device"),
        F.col("props").alias("raw_payload"),
    )


def engagement_arrivals(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Engagements with their place in the merged feed."""
    return engagement(spark, sf_dir, stream).withColumn("seq", F.col("id") * 3)


def with_arrival_time(rows: DataFrame) -> DataFrame:
    """A feed that delivers one message per second."""
    return rows.withColumn("arrival_ts", F.timestamp_seconds("seq"))


def flawed_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagements with missing required fields and unknown event types."""
    number = F.col("id")
    return (
        engagement(spark, sf_dir)
        .withColumn("device", F.when(number % 13 != 0, F.col("device")))
        .withColumn("user_id", F.when(number % 17 != 0, F.col("user_id")))
        .withColumn("content_id", F.when(number % 19 != 0, F.col("content_id")))
        .withColumn(
            "event_type",
            F.when(number % 23 == 0, F.lit(None).cast("string"))
            .when(number % 5 == 0, F.concat(F.lit("x-"), F.col("event_type")))
            .otherwise(F.col("event_type")),
        )
    )


def engagement_feed(
    spark: SparkSession, sf_dir: str, mixed: bool = True, stream: bool = False
) -> DataFrame:
    """Engagements as JSON messages: all plain, or in every shape a feed may hold.

    The shape follows from the id: plain, wrapped, wrapped with an unknown
    field, delete, delete that hides a wrapped image, three kinds without an
    image, JSON that is no object (null, array), and broken JSON.
    """
    rows = engagement_arrivals(spark, sf_dir, stream)
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    image = F.to_json(
        F.struct(*[
            stamp.alias("event_ts") if c == "event_ts" else F.col(c)
            for c in rows.columns if c != "seq"
        ]),
        {"ignoreNullFields": "false"},
    )
    number, shape = F.col("id"), F.col("id") % SHAPES if mixed else F.lit(0)
    log = F.concat(F.lit('"source":{"lsn":'), F.col("seq").cast("string"), F.lit("}"))
    extra = F.concat(F.left(image, F.length(image) - 1), F.lit(',"zz":1}'))

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    value = (
        F.when(shape == 1, text('{"schema":{},"payload":{"before":null,"after":', image, ",", log, "}}"))
        .when(shape == 2, text('{"payload":{"after":', extra, ",", log, "}}"))
        .when(shape == 3, text('{"before":', image, ',"after":null}'))
        .when(shape == 4, text('{"after":null,"payload":{"after":', image, "}}"))
        .when(shape == 5, text('{"payload":null,"n":', number.cast("string"), "}"))
        .when(shape == 6, text('{"payload":[', number.cast("string"), "]}"))
        .when(shape == 7, text('{"foo":', number.cast("string"), "}"))
        .when(shape == 8, F.lit("null"))
        .when(shape == 9, text("[", number.cast("string"), "]"))
        .when(shape == 10, text("not json ", number.cast("string")))
        .otherwise(text('{"before":null,"after":', image, ',"op":"c",', log, "}"))
    )
    return rows.select(
        F.lit("pgcdc.public.engagement_events").alias("topic"), value.alias("value"), "seq"
    )


def drifted_engagement_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain engagement messages whose images bring fields no schema names.

    ``app_version`` is text, ``volume`` a whole or a broken number, ``ref`` a number or
    text, ``geo`` an object, ``muted`` a truth value or null, ``gone`` always null, and
    ``Device`` differs from a known field by case alone.
    """
    rows = engagement_feed(spark, sf_dir, mixed=False)
    number = F.floor(F.col("seq") / 3)  # the event's id

    def field(name: str, value: Column, when: Column) -> Column:
        return F.when(when, F.concat(F.lit(f',"{name}":'), value)).otherwise(F.lit(""))

    text = number.cast("string")
    extra = F.concat(
        field("app_version", F.concat(F.lit('"v'), (number % 9).cast("string"), F.lit('"')), number % 4 == 0),
        field("volume", F.when(number % 2 == 0, text).otherwise(F.concat(text, F.lit(".5"))), number % 3 == 0),
        field("ref", F.when(number % 5 == 0, text).otherwise(F.concat(F.lit('"r'), text, F.lit('"'))), number % 7 < 3),
        field("geo", F.concat(F.lit('{"zone":'), (number % 8).cast("string"), F.lit("}")), number % 10 == 0),
        field("muted", F.when(number % 12 == 0, F.lit("null")).otherwise((number % 4 == 2).cast("string")), number % 2 == 0),
        field("gone", F.lit("null"), number % 6 == 5),
        field("Device", F.lit('"d"'), number % 13 == 0),
    )
    # the image is the last object but one: its end is the first '},"op"'
    return rows.withColumn("value", F.concat(
        F.substring_index("value", '},"op":"c"', 1), extra, F.lit('},"op":"c"'), F.substring_index("value", '},"op":"c"', -1)))


def content_feed(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The catalogue snapshot as plain change messages; some lack ``publish_ts``."""
    rows = content(spark, sf_dir, stream)
    number = F.substr("id", F.lit(3)).cast("bigint")
    stamp = F.when(number % 4 != 0, F.date_format("publish_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    image = F.to_json(
        F.struct(*[stamp.alias(c) if c == "publish_ts" else F.col(c) for c in rows.columns])
    )
    return rows.select(
        F.lit("pgcdc.public.content").alias("topic"),
        F.concat(F.lit('{"before":null,"after":'), image, F.lit(',"op":"r","ts_ms":0}')).alias("value"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def foreign_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a schema the capture does not include."""
    return _table(spark, sf_dir, "supplier").select(
        F.lit("pgcdc.audit.supplier").alias("topic"),
        F.concat(F.lit('{"after":{"id":'), F.col("s_suppkey").cast("string"), F.lit("}}")).alias("value"),
        F.lit(0).cast("bigint").alias("seq"),
    )
