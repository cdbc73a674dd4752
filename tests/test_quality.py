from pulsemill.operators import quality
from pulsemill.schemas import CONTENT_TYPES, EVENT_TYPES
from tests.test_enrich import events


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", "c")], "id long, x string, y string")
    good, rejects = quality.split_required(df, ["id", "x", "y"])
    assert [r.id for r in good.collect()] == [3]
    assert {r.id: r.missing for r in rejects.collect()} == {1: ["y"], 2: ["x", "y"]}


def test_domains_let_null_pass(spark):
    df = spark.createDataFrame(
        [(1, "play", "podcast"), (2, "view", None), (3, None, "book"), (4, "like", "book")],
        "id long, event_type string, content_type string",
    )
    rejects = quality.domain_rejects(df, {"event_type": EVENT_TYPES, "content_type": CONTENT_TYPES})
    assert {r.id: r.violations for r in rejects.collect()} == {
        2: ["event_type"], 3: ["content_type"], 4: ["event_type", "content_type"]}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "slug string")
    assert [(r.slug, r.copies) for r in quality.duplicate_keys(df, "slug").collect()] == [("a", 2)]


def test_references_let_null_pass(spark):
    content = spark.createDataFrame([("c",)], "id string")
    facts = events(spark, [(1, "c", 1), (2, "x", 1), (3, None, 1)])
    for ways in ({}, {"broadcast_bytes": 0}):
        assert [r.id for r in quality.referential_rejects(facts, content, **ways).collect()] == [2]
