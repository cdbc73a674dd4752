"""Derived engagement measures and the rounding they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLIT = float(2 ** 27 + 1)  # splits a double into two halves of at most 26 bits


def with_nearest_decimal(df: DataFrame, name: str, source: Column, digits: int) -> DataFrame:
    """Add ``name``: non-negative ``source`` rounded to ``digits`` decimals, exactly.

    The tie is decided on the exact binary value (half to even), which is how
    the feed's producers round.  ``round``/``bround`` decide on the shortest
    decimal text instead and differ in about one of ten thousand values.

    ``x * 10^digits`` is taken as an unevaluated sum ``p + e`` (product and its
    rounding error), so only double arithmetic is needed and the expression
    stays in generated code.  Each step is its own column: Catalyst then
    computes it once per row.
    """
    scale = float(10 ** digits)
    x, p, h = (F.col(f"__{name}_{part}") for part in "xph")
    error = (h * scale - p) + (x - h) * scale
    whole = F.floor(p)
    beyond = (p - whole) - 0.5
    odd = F.pmod(whole, F.lit(2)) == 1
    up = (beyond > 0) | ((beyond == 0) & ((error > 0) | ((error == 0) & odd)))
    steps = df.withColumn(f"__{name}_x", source).withColumns({
        f"__{name}_p": x * scale,
        f"__{name}_h": x * _SPLIT - (x * _SPLIT - x),
    })
    rounded = (whole + F.when(up, 1).otherwise(0)) / F.lit(scale)
    return steps.select(*df.columns, rounded.alias(name))


def engagement_seconds(duration_ms: Column) -> Column:
    """Milliseconds to seconds; null for a missing or negative duration.

    A whole number of milliseconds over 1000 already is the double nearest to
    its three-decimal value, so no further rounding is needed.
    """
    return F.when(duration_ms >= 0, duration_ms.cast("double") / F.lit(1000.0))


def with_measures(df: DataFrame, known: Column | None = None) -> DataFrame:
    """Add ``engagement_seconds`` and ``engagement_pct``.

    Needs ``duration_ms`` and ``length_seconds``.  Both stay null where the
    content is not ``known``.  The share is not clamped: it passes 100 when more
    was played than the content is long.
    """
    seconds = engagement_seconds(F.col("duration_ms"))
    df = df.withColumn("engagement_seconds", seconds if known is None else F.when(known, seconds))
    share = F.when(
        F.col("length_seconds") > 0,
        F.col("engagement_seconds") / F.col("length_seconds") * F.lit(100.0),
    )
    return with_nearest_decimal(df, "engagement_pct", share, 2)


def on_grid(value: Column, digits: int = 4) -> Column:
    """Put a double aggregate on a decimal grid for reports.

    The last bits of a sum of doubles depend on the order of the rows.  The
    small offset keeps values that lie on a tie from flipping with them.
    """
    scale = float(10 ** digits)
    return F.floor(value * scale + (0.5 + 1e-5)) / F.lit(scale)


def approx_quantiles(value: Column | str, buckets: int, accuracy: int = 10_000) -> Column:
    """Array of ``buckets + 1`` approximate quantiles, minimum to maximum."""
    return F.percentile_approx(value, [i / buckets for i in range(buckets + 1)], accuracy)


def quantile_at(value: Column | str, buckets: int, offset: int, accuracy: int = 10_000) -> Column:
    """Entry ``offset`` (zero-based) of ``approx_quantiles`` without the rest."""
    return F.percentile_approx(value, offset / buckets, accuracy)
