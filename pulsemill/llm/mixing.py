"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key with its quality weight as rate; the documents of
a source in key order are a weighted sample without replacement of any length. A source's
target is filled with complete epochs first, then with the documents of least key whose
sizes add up to the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.common import saved, word_count

SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"
GOOD, UNKNOWN, POOR = 2.0, 1.0, 0.5  # document weights by label
BINS = 1 << 14  # key ranges of a source, so that no task sorts a whole source


def document_weights(labels: DataFrame) -> DataFrame:
    """Rows (doc_id, weight); poor if any label of the document says low quality or toxic."""
    good = F.min((F.coalesce("quality", F.lit(1)) > 0) & (F.coalesce("toxic", F.lit(0)) == 0))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.when(good, GOOD).otherwise(POOR).alias("weight"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """Target of each source, from rows (name, source, source_size).

    Weights repeat over the sources in code point order, null last. Targets share the sum
    of all sizes, none above MOST_EPOCHS times its source: sources are taken by the level
    at which they reach that bound, and the level is the first that leaves the next ones
    below it. One row per source, so the window holds no documents.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    n = (F.row_number().over(everything) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (n + 1).cast("int"))
    bound = (MOST_EPOCHS * F.col("source_size")).cast("double")
    weighed = sizes.withColumn("w", weight).withColumn("reach", bound / F.col("w"))
    order = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    filled = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST_EPOCHS
    rest = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))
    levels = weighed.withColumn(
        "level", (F.sum("source_size").over(whole) - filled).cast("double") / rest
    ).withColumn("place", F.row_number().over(order))
    first = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("place", "level"))).over(whole)
    return levels.withColumn("chosen", first["level"]).select(
        "name", "source", "source_size",
        F.least(F.col("chosen") * F.col("w"), bound).alias("target"))


def row_key(seed: str = SEED) -> Column:
    """Names a document by id and text; null counts as empty."""
    return F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit("")),
        F.lit(seed)).cast("binary"))


def mixed(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: size, source_size, target, copies and taken = size * copies.

    Size is the number of words, 0 for null. Copies are the complete epochs of its source,
    and one more for documents of least key up to the rest of the target; the last one is
    taken if at least half of it fits. ``row_key`` names id and text, which also decide the
    key: reruns agree, and repeated rows are ties that are told apart arbitrarily, which
    their equal values don't show. A source of empty documents only has target 0.
    """
    uniform = (F.conv(F.substring("row_key", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    rows = docs.select(
        "doc_id", "source", word_count("text").alias("size"), row_key(seed).alias("row_key")
    ).join(document_weights(labels), "doc_id", "left")
    key = -F.log(uniform) / F.coalesce("weight", F.lit(UNKNOWN))
    rows = saved(
        rows.select(
            "doc_id", "size", "row_key", "source",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), key.alias("key"),
        ).withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS)), "keys")

    bins = rows.groupBy("name", "bin").agg(
        F.sum("size").alias("bin_size"), F.first("source").alias("source"))
    sizes = bins.groupBy("name").agg(
        F.sum("bin_size").alias("source_size"), F.first("source").alias("source"))
    earlier = Window.partitionBy("name").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.join(targets(sizes).drop("source"), "name").select(
        "name", "bin", "source_size", "target",
        F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("start"))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0)).cast("long")
    within = Window.partitionBy("name", "bin").orderBy("key", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = rows.join(starts, ["name", "bin"]).withColumn("epochs", epochs).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = (2 * F.col("before") + F.col("size") <= 2 * rest) & (F.col("size") > 0)
    return placed.withColumn("copies", F.col("epochs") + more.cast("long")).select(
        "doc_id", "source", "row_key", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))
