"""Fields a feed brings that no schema names: which there are, of what type, and their promotion to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

SCALARS = ("STRING", "BOOLEAN", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ")
EXACT = "decimal(38,18)"
NUMBERS = r"^(BIGINT|FLOAT|DOUBLE|DECIMAL\(.*\))$"


def discovered_fields(rows: DataFrame, extras: str = "extras") -> DataFrame:
    """(field, type, n_rows, n_null) for every unknown field, from all rows of a feed.

    ``type`` merges the types of all values: numbers widen, objects merge their keys, and
    values that agree on nothing give VARIANT; VOID means that only nulls came. Merging
    combines before the shuffle, so a field in every row is one small row a task.
    """
    entries = rows.select(F.explode(extras).alias("field", "value"))
    return entries.groupBy("field").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("n_rows"),
        F.count_if(F.is_variant_null("value")).alias("n_null"))


def _scalar(kind: str | Column) -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    return kind.isin(*SCALARS) | kind.rlike(NUMBERS)


def agreed_schema(found: DataFrame, known: T.StructType, min_rows: int = 1, most: int = 200) -> T.StructType:
    """The fields to promote: one scalar type in at least ``min_rows`` rows, not known yet.

    Column names know no case, so a field that differs from a known column or from a more
    frequent field by case alone stays among the extras. ``most`` bounds the table's width
    (a feed may use ids as field names): the most frequent fields come first.
    """
    taken = [f.name.lower() for f in known.fields]
    wanted = found.where(_scalar("type") & (F.col("n_rows") - F.col("n_null") >= min_rows)).where(
        ~F.lower("field").isin(*taken) if taken else F.lit(True))
    one = F.struct(F.col("n_rows"), F.col("field"), F.col("type"))
    best = wanted.groupBy(F.lower("field").alias("name")).agg(F.max(one).alias("best")).select("best.*")
    rows = best.orderBy(F.desc("n_rows"), "field").limit(most).collect()
    return T.StructType([T.StructField(r.field, T.DataType.fromDDL(r.type)) for r in sorted(rows, key=lambda r: r.field)])


def promoted(rows: DataFrame, fields: T.StructType, extras: str = "extras") -> DataFrame:
    """Rows with ``fields`` as columns, taken out of the extras.

    A value leaves the extras only where its column says the same: one of another kind, a
    null, or a number the column's type would round stays, and the column is null. Extras
    without entries become null. A number in a DOUBLE column is as exact as a double.
    """
    read, fits = {}, []
    for f in fields.fields:
        value = F.try_element_at(F.col(extras), F.lit(f.name))
        kind, own = F.schema_of_variant(value), f.dataType.simpleString()
        column = F.try_variant_get(value, "$", own)
        if isinstance(f.dataType, T.DoubleType):
            same = kind.rlike(NUMBERS) & column.isNotNull()
        elif isinstance(f.dataType, T.NumericType):
            # the widest decimal has room for what JSON readers keep exact; beyond it doubles decide
            same = kind.rlike(NUMBERS) & F.coalesce(
                F.try_variant_get(value, "$", EXACT) == column.try_cast(EXACT),
                F.try_variant_get(value, "$", "double") == column.cast("double"))
        else:
            same = kind == own.upper()
        read[f.name] = F.when(same, column)
        fits.append(F.when(same, F.lit(f.name)))
    if not read:
        return rows
    gone = F.array_compact(F.array(*fits))
    rest = F.map_filter(extras, lambda k, _: ~F.array_contains(gone, k))
    return rows.withColumns({**read, extras: F.when(F.size(rest) > 0, rest)})
