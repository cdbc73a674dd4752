"""JSON documents and keys of enriched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from pulsemill.schemas import ADDED_COLUMNS, EVENT_COLUMNS

# Fixed value: prefix of the keys.
KEY_PREFIX = "eng:"


def event_key(content_id: Column, event_id: Column) -> Column:
    """``eng:{<content id>}:<event id>``; the braces are part of the key.

    An event without content id is filed under ``None``.
    """
    item = F.coalesce(content_id, F.lit("None"))
    return F.concat(F.lit(KEY_PREFIX + "{"), item, F.lit("}:"), event_id.cast("string"))


def iso_instant(df: DataFrame, column: str) -> Column:
    """UTC instant as ISO-8601 text with microseconds and ``Z``."""
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        c = F.to_utc_timestamp(c, F.current_timezone())
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def event_json(df: DataFrame) -> Column:
    """One enriched event as compact JSON, nulls kept.

    A row whose content never came has no enriched fields, only
    ``_content_missing``.  Unknown feed fields (``extras``) follow the known ones.
    """
    own = [
        iso_instant(df, n).alias(n) if n == "event_ts" else F.col(n) for n in EVENT_COLUMNS
    ]
    text = _json(*own, *[F.col(n) for n in ADDED_COLUMNS])
    if "content_missing" in df.columns:
        flagged = _json(*own, F.lit(True).alias("_content_missing"))
        text = F.when(F.col("content_missing"), flagged).otherwise(text)
    if "extras" in df.columns:
        extras = F.to_json(F.col("extras"), {"ignoreNullFields": "false"})
        joined = F.concat(
            F.left(text, F.length(text) - 1), F.lit(","), F.substr(extras, F.lit(2))
        )
        text = F.when(F.col("extras").isNotNull(), joined).otherwise(text)
    return text


def last_name_part(dotted: Column) -> Column:
    """``schema.table`` or ``server.schema.table`` to ``table``."""
    return F.split_part(dotted, F.lit("."), F.lit(-1))
