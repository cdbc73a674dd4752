"""From raw documents to a clean, mixed and sharded corpus, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import decontaminate, histogram_sort, mixing, near_dedup, resample
from pulsemill.llm.common import saved, set_aside, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

N_SHARDS = 40


def one_per_key(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key: the least by the JSON of all its columns, so reruns agree."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the importance sample holds: of quality, and without the words of toxic ones.

    The score decides on each row by its text, whatever its id. Texts without words are left out.
    """
    aside = set_aside(docs, "doc_id", "text")
    sampled = resample.quality_sample(aside, table(spark, sf_dir, "labels"), carried=aside.columns)
    return sampled.where("selected").select(*aside.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the least doc_id.

    Rows without doc_id stay unless a row of their class has one. Of rows that repeat id
    and text one stays; a repeated id with an unlike text is another document.
    """
    keyed = set_aside(docs, "doc_id", "text").withColumn("row_key", mixing.row_key())
    keepers = saved(near_dedup.one_of_each(keyed.select("doc_id", "text", "row_key"), "row_key"), "keepers")
    kept = keyed.join(keepers.where("n = 1"), "row_key", "left_semi")
    again = keepers.where("n > 1")
    if not again.isEmpty():
        kept = kept.unionByName(one_per_key(keyed.join(again, "row_key", "left_semi"), "row_key"))
    return kept.drop("row_key").toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: once per complete epoch, once more if drawn.

    Rows with equal id, text and source share what the mix takes of all of them.
    """
    aside = set_aside(docs, "doc_id", "text", "source")
    taken = mixing.mixed(docs, table(spark, sf_dir, "labels"))
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name")
    copies = saved(
        taken.groupBy("row_key", name).agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
        .where("copies > 0"), "copies")
    keyed = aside.select("*", mixing.row_key().alias("row_key"), name)
    once = keyed.join(copies.where("n = 1").drop("n"), ["row_key", "name"])
    again = copies.where("n > 1").drop("n")
    if not again.isEmpty():
        once = once.unionByName(
            one_per_key(keyed.join(again, ["row_key", "name"]), "row_key", "name").select(*once.columns))
    return once.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    ).select(*aside.columns).toDF(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it, and size and checksum of its text."""
    return histogram_sort.sharded_documents(docs, N_SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the sketches and the sampling hashes have no SQL form.
ORACLE_SQL = None
