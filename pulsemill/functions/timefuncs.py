"""Instants, UTC dates and range predicates that prune partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

Instant = str | dt.datetime | dt.date | None


def parse_instant(text: Column) -> Column:
    """ISO-8601 text (``Z``, offset or none, any fraction) to a timestamp, else null.

    Text without a zone is read in the session zone, which is UTC.
    """
    return text.try_cast("timestamp")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def utc_date(df: DataFrame, column: str = "event_ts") -> Column:
    """DATE(ts) in UTC, whatever the session zone is."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.to_date(c)
    return F.to_date(F.to_utc_timestamp(c, F.current_timezone()))


def instant(value: Instant, dtype: T.DataType) -> Column:
    """``value`` (UTC when it names no zone) as a literal of a column's type.

    None is the moment of the query.
    """
    ntz = isinstance(dtype, T.TimestampNTZType)
    if value is None:
        if ntz:
            return F.expr("convert_timezone('UTC', cast(current_timestamp() as timestamp_ntz))")
        return F.current_timestamp()
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz") if ntz else F.lit(text + "Z").cast("timestamp")


def hours_before(moment: Column, hours: int) -> Column:
    """Whole hours earlier: unlike days, the same in zones that change their clocks."""
    return moment - F.expr(f"INTERVAL {int(hours)} HOUR")


def utc_day(moment: Column, dtype: T.DataType) -> Column:
    """UTC date of an instant of a column's type."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(moment)
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def _utc_midnight(moment: Column, dtype: T.DataType) -> Column:
    """First instant of the UTC date of ``moment``.

    UTC days are whole multiples of 24 hours since the epoch, in any session zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_trunc("day", moment).cast("timestamp_ntz")
    micros = F.unix_micros(moment)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(DAY_MICROS)))


def _with_date_range(
    df: DataFrame, kept: Column, low: Column, high: Column | None, dtype: T.DataType
) -> DataFrame:
    """Repeat a time range on ``event_date`` where the table is partitioned by it.

    A filter on the timestamp alone reaches the row groups but does not prune
    folders.
    """
    df = df.where(kept)
    if "event_date" in df.columns:
        df = df.where(F.col("event_date") >= utc_day(low, dtype))
        if high is not None:
            df = df.where(F.col("event_date") <= utc_day(high, dtype))
    return df


def between(df: DataFrame, start: Instant, end: Instant, column: str = "event_ts") -> DataFrame:
    """Rows with ``start <= column <= end``."""
    dtype = df.schema[column].dataType
    low, high = instant(start, dtype), instant(end, dtype)
    return _with_date_range(df, F.col(column).between(low, high), low, high, dtype)


def last_days(df: DataFrame, days: int, as_of: Instant = None, column: str = "event_ts") -> DataFrame:
    """Rows of the ``days`` x 24 hours up to and including ``as_of``."""
    dtype = df.schema[column].dataType
    high = instant(as_of, dtype)
    low = hours_before(high, 24 * days)
    return _with_date_range(df, F.col(column).between(low, high), low, high, dtype)


def since_date(df: DataFrame, days: int, today: Instant = None, column: str = "event_ts") -> DataFrame:
    """Rows whose UTC date is ``today`` minus ``days`` or later.

    Written on the timestamp itself so that it is pushed to the scan.
    """
    dtype = df.schema[column].dataType
    low = hours_before(_utc_midnight(instant(today, dtype), dtype), 24 * days)
    return _with_date_range(df, F.col(column) >= low, low, None, dtype)


def on_date(df: DataFrame, day: Instant = None, column: str = "event_ts") -> DataFrame:
    """Rows whose UTC date is ``day``."""
    dtype = df.schema[column].dataType
    low = _utc_midnight(instant(day, dtype), dtype)
    kept = (F.col(column) >= low) & (F.col(column) < hours_before(low, -24))
    return _with_date_range(df, kept, low, low, dtype)
