"""Table schemas as StructTypes, with column comments as field metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

CONTENT = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("slug", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content_type", T.StringType()),
    T.StructField("length_seconds", T.LongType()),
    T.StructField("publish_ts", T.TimestampType(), False),
])

ENGAGEMENT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("content_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_ts", T.TimestampType(), False),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("device", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
])

# The warehouse contract (name, type, mode, description).
WAREHOUSE_FIELDS = [
    ("id", "INTEGER", "REQUIRED", "Event identifier"),
    ("content_id", "STRING", "REQUIRED", "Content the user engaged with"),
    ("user_id", "STRING", "REQUIRED", "User of the engagement"),
    ("event_type", "STRING", "REQUIRED", "play, pause, finish or click"),
    ("event_ts", "TIMESTAMP", "REQUIRED", "Instant of the engagement"),
    ("duration_ms", "INTEGER", "NULLABLE", "Milliseconds engaged, null where an event has none"),
    ("device", "STRING", "REQUIRED", "Device kind"),
    ("raw_payload", "STRING", "REQUIRED", "Client payload as JSON text"),
    ("content_type", "STRING", "NULLABLE", "Kind of content, from the catalogue"),
    ("length_seconds", "INTEGER", "NULLABLE", "Length of the content, from the catalogue"),
    ("engagement_seconds", "FLOAT", "NULLABLE", "duration_ms in seconds"),
    ("engagement_pct", "FLOAT", "NULLABLE", "Share of the content engaged with, in percent"),
]

TABLE_DESCRIPTION = "Engagement events with catalogue attributes and derived measures"
TABLE_LABELS = {"written_by": "pulsemill"}

# Allowed codes of the two CHECK constraints.
CONTENT_TYPES = ("podcast", "newsletter", "video")
EVENT_TYPES = ("play", "pause", "finish", "click")

_SPARK_TYPES = {
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
}


def from_field_list(fields: list[dict]) -> T.StructType:
    """StructType for a list of {name, type, mode, description} entries."""
    struct = []
    for field in fields:
        kind = field["type"].upper()
        if kind not in _SPARK_TYPES:
            raise ValueError(f"unknown field type {field['type']!r} of {field['name']!r}")
        comment = field.get("description")
        struct.append(T.StructField(
            field["name"], _SPARK_TYPES[kind],
            field.get("mode", "NULLABLE").upper() != "REQUIRED",
            {"comment": comment} if comment else None,
        ))
    return T.StructType(struct)


def load_schema(path: str) -> T.StructType:
    """Read a JSON field list; a missing or malformed file raises."""
    with open(path, encoding="utf-8") as handle:
        return from_field_list(json.load(handle))


ENRICHED = from_field_list([
    {"name": n, "type": t, "mode": m, "description": d} for n, t, m, d in WAREHOUSE_FIELDS
])
REQUIRED_COLUMNS = tuple(f.name for f in ENRICHED.fields if not f.nullable)
EVENT_COLUMNS = tuple(ENGAGEMENT.fieldNames())
ADDED_COLUMNS = ("content_type", "length_seconds", "engagement_seconds", "engagement_pct")


def with_comments(df: DataFrame, schema: T.StructType = ENRICHED) -> DataFrame:
    """Attach the schema's column comments to matching columns of ``df``."""
    for field in schema.fields:
        if field.metadata and field.name in df.columns:
            df = df.withMetadata(field.name, field.metadata)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` in its order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
