"""The registered text queries, and the pipeline, on the test tables."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsemill.llm import mixing, queries, resample
from pulsemill.llm.common import table, word_count
from tests.compare import database, differences
from tests.llm.data import DOCS, frame, prose, spaced

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), database(SF_DIR), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_one_row_per_input_row(spark, name):
    source = "pages" if name in ("op2_arc_to_warc", "op6_page_diff") else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    ids = queries.QUERIES[name](spark, SF_DIR).select(key)
    assert sorted(ids.collect()) == sorted(table(spark, SF_DIR, source).select(key).collect())


def test_word_count(spark):
    rows = frame(spark).withColumn("n", word_count("text")).collect()
    assert all(r.n == len(spaced(r.text)) for r in rows)


def test_pipeline(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    docs = table(spark, SF_DIR, "documents")
    assert set(docs.columns) | {"shard", "slot"} <= set(result.columns)
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in result.collect()} <= ids
    labels = table(spark, SF_DIR, "labels").where("quality = 1").join(docs, "doc_id")
    kept = corpus_pipeline.quality(spark, docs, SF_DIR)
    assert labels.join(kept.select("doc_id"), "doc_id", "left_semi").count() >= 0.95 * labels.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_awkward_documents(spark, stage):
    docs = frame(spark)
    result = stage(spark, docs, SF_DIR)
    assert set(docs.columns) <= set(result.columns)
    assert result.select("doc_id", F.length("text")).count() <= 3 * docs.count()
    assert stage(spark, frame(spark, []), SF_DIR).count() == 0


def awkward_ids(spark):
    """(rows, how they count): null ids, ids that repeat with another text or another source."""
    a, b, c, d = (prose(60, seed) for seed in (21, 22, 23, 24))
    return spark.createDataFrame([
        (None, a, "en", "s0", 1), (None, b, "en", "s0", 2), (7, c, "en", "s0", 3), (7, d, "en", "s1", 4),
        (8, a, "en", "s0", 5), (9, d, "en", "s0", 6), (9, d, "en", "s1", 7),
    ], DOCS)


def test_near_duplicates_name_rows_by_id_and_text(spark):
    docs = awkward_ids(spark)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    # a: the row with an id leads; b: no id, but alone; c and d are both of id 7
    assert sorted(r.n_chars for r in kept.collect()) == [2, 3, 4, 5]
    repeated = docs.where("doc_id = 9")
    assert [r.source for r in corpus_pipeline.near_duplicates(spark, repeated, SF_DIR).collect()] == ["s0"]


def test_quality_decides_rows_without_id_by_their_text(spark):
    docs = table(spark, SF_DIR, "documents")
    plain = corpus_pipeline.quality(spark, docs, SF_DIR)
    assert 0 < plain.count() < docs.count()
    sampled = resample.quality_sample(docs, table(spark, SF_DIR, "labels")).where("selected")
    assert sorted(r.doc_id for r in plain.collect()) == sorted(r.doc_id for r in sampled.collect())
    nameless = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    kept = corpus_pipeline.quality(spark, nameless, SF_DIR)
    lost = kept.where("doc_id is null").count()
    assert 0.8 * plain.count() < lost < 1.2 * plain.count()


def test_mix_keeps_sources_of_a_repeated_row_apart(spark):
    docs = awkward_ids(spark)
    rows = corpus_pipeline.mix(spark, docs, SF_DIR).collect()
    taken = {(r.doc_id, r.source): 0 for r in docs.collect()}
    for r in mixing.mixed(docs, table(spark, SF_DIR, "labels")).collect():
        taken[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in rows) == Counter({k: n for k, n in taken.items() if n})
