"""Change envelopes: JSON text to after-image, with a reason where there is none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from pulsemill.functions.timefuncs import parse_instant

INVALID_JSON = "invalid_json"
NO_AFTER = "no_after"
DELETE = "delete"
BAD_ROW = "bad_row"

LOG_POSITION, TIME_POSITION = "lsn", "ts_ms"

# Fixed value: publish time of content that names none.
DEFAULT_PUBLISH_TS = "2024-01-01T00:00:00Z"

_OBJECT = "map<string,string>"


def evaluated_once(df: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """Select ``kept`` and computed ``columns`` such that each row computes them once.

    A later filter on a plain projection is pushed below it, which repeats the
    whole expression: here, parsing the message again for each mention.  Columns
    that come out of a generator stay where they are.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def with_after_image(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``after`` (JSON text or null) and ``reason`` (null for a usable row).

    Plain envelopes carry ``after`` at the top, wrapped ones under ``payload``.
    Whether the key is present decides, not its value: a top-level
    ``"after": null`` is a delete even if ``payload.after`` exists.  A message is
    parsed once, and a second time only for its payload or to tell broken JSON
    from JSON that is no object.
    """
    text = F.col(value).cast("string")
    top, inner = F.col("__top"), F.col("__inner")
    plain = F.map_contains_key(top, F.lit("after"))
    wrapped = F.map_contains_key(inner, F.lit("after"))
    return (
        df.withColumn("__top", F.from_json(text, _OBJECT))
        .withColumn("__inner", F.when(~plain, F.from_json(top["payload"], _OBJECT)))
        .withColumn("after", F.when(plain, top["after"]).otherwise(inner["after"]))
        .withColumn(
            "reason",
            F.when(F.col("after").isNotNull(), F.lit(None).cast("string"))
            .when(plain | wrapped, F.lit(DELETE))
            .when(top.isNotNull(), F.lit(NO_AFTER))
            .when(F.try_parse_json(text).isNotNull(), F.lit(NO_AFTER))
            .otherwise(F.lit(INVALID_JSON)),
        )
        .drop("__top", "__inner")
    )


def feed_position(value: Column, kind: str = LOG_POSITION) -> Column:
    """Position of a change: ``source.lsn``, or the ``ts_ms`` stamp, as ``kind`` says.

    A feed has one kind. The two have different scales, so a change without its
    feed's kind has no position, and is taken as it comes.
    """
    text = value.cast("string")
    if kind == LOG_POSITION:
        paths = ("$.source.lsn", "$.payload.source.lsn")
    elif kind == TIME_POSITION:
        paths = ("$.ts_ms", "$.payload.ts_ms")
    else:
        raise ValueError(f"unknown kind of position: {kind}")
    return F.coalesce(*[F.get_json_object(text, p).try_cast("bigint") for p in paths])


def _text_schema(schema: T.StructType) -> T.StructType:
    """Timestamps are read as text first: ISO forms are parsed by ``parse_instant``."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in schema.fields
    ])


def typed_row(after: Column, schema: T.StructType) -> Column:
    """After-image JSON to a struct; a field of the wrong type becomes null."""
    return F.from_json(after, _text_schema(schema), {"mode": "PERMISSIVE"})


def typed_fields(row: str, schema: T.StructType) -> dict[str, Column]:
    """The struct's fields by name, ISO text turned into instants."""
    fields = {}
    for f in schema.fields:
        c = F.col(f"{row}.{f.name}")
        fields[f.name] = parse_instant(c) if isinstance(f.dataType, T.TimestampType) else c
    return fields


def extra_fields(after: Column, schema: T.StructType) -> Column:
    """Fields of the after-image that the schema does not name, as name -> variant.

    Null where there are none: only images with an unknown field are parsed again.
    """
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    unknown = F.array_except(F.json_object_keys(after), known)
    rest = F.map_filter(
        F.from_json(after, "map<string,variant>"), lambda k, _: ~F.array_contains(known, k)
    )
    return F.when(F.size(unknown) > 0, rest)
