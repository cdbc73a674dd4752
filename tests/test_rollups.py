"""Rollups against the queries on the events themselves."""

import math

import pytest
from pyspark.sql import functions as F

from pulsemill.operators.enrich import enrich_snapshot
from pulsemill.plans import insights, rollups as R
from pulsemill.sources import fixtures
from pulsemill.streaming import job

SF_DIR = "/root/testdata/sf0.001"
AS_OF = "2024-01-24 13:45:10"


@pytest.fixture(scope="module")
def events(spark):
    rows = enrich_snapshot(fixtures.engagement(spark, SF_DIR), fixtures.content(spark, SF_DIR))
    return rows.withColumn("length_seconds", F.col("length_seconds") + F.col("id") % 5).cache()


@pytest.fixture(scope="module")
def path(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollups"))
    for batch in range(3):
        R.write_batch(events.where(F.col("id") % 3 == batch), path, batch)
    R.write_batch(events.where(F.col("id") % 3 == 1), path, 1)  # a repeated batch
    return path


def close(a, b):
    rows = [sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[:-1])) for df in (a, b)]
    assert len(rows[0]) == len(rows[1]) > 0
    for x, y in zip(*rows, strict=True):
        for u, v in zip(x, y, strict=True):
            assert u == v or math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9), (x, y)


@pytest.mark.parametrize("compacted", [False, True])
def test_equal_the_events(spark, events, path, tmp_path, compacted):
    if compacted:
        for name in R.KEYS:
            R.compact(spark, path, name, str(tmp_path))
        path = str(tmp_path)
        days = R.read(spark, path, R.CONTENT)
        assert days.count() == days.select("event_date", "content_id").distinct().count()

    def rows(name, days):
        return R.over_days(R.read(spark, path, name), events, name, days, AS_OF)

    close(R.type_device_engagement(rows(R.TYPE_DEVICE, 7)), insights.type_device_engagement(events, AS_OF))
    close(R.device_variability(rows(R.TYPE_DEVICE, 30)), insights.device_variability(events, AS_OF))
    close(R.length_correlation(rows(R.TYPE_DEVICE, 7)), insights.length_correlation(events, AS_OF))
    ends = ("2024-01-03 01:02:03", "2024-01-20 05:06:07")
    ranged = R.over_range(R.read(spark, path, R.TYPE_DEVICE), events, R.TYPE_DEVICE, *ends)
    close(R.device_statistics(ranged), insights.device_statistics(events, *ends))
    ranged = R.over_range(R.read(spark, path, R.CONTENT), events, R.CONTENT, *ends)
    close(R.inconsistent_content(ranged), insights.inconsistent_content(events, *ends))


def test_users(spark, events, path):
    plays = R.over_range(R.read(spark, path, R.USER_PLAYS), events, R.USER_PLAYS, "2024-01-17 00:00:00", "2024-01-31 00:00:00")
    close(R.user_engagement_patterns(plays, 2).select("user_id", "total_events", "unique_content", "avg_engagement_pct"),
          insights.user_engagement_patterns(events, "2024-01-24", min_events=2))


def test_quantiles_by_rank(spark, events, path):
    rows = R.over_days(R.read(spark, path, R.TYPE_DEVICE), events, R.TYPE_DEVICE, 30, AS_OF)
    raw = insights.last_days(events, 30, AS_OF).where("engagement_seconds is not null").select(
        "content_type", "engagement_seconds").toPandas()
    for r in R.p90_seconds_by_type(rows).collect():
        own = raw.engagement_seconds[raw.content_type == r.content_type]
        if len(own):
            below, upto = (own < r[1]).mean(), (own <= r[1]).mean()
            assert below - 0.03 <= 0.9 <= upto + 0.03


def test_only_the_ends_are_read_from_the_events(spark, events, path):
    """A range of whole days takes nothing from the events but the very end."""
    dated = events.withColumn("event_date", F.to_date("event_ts"))
    whole = R.over_range(R.read(spark, path, R.CONTENT).limit(0), dated, R.CONTENT, "2024-01-05 00:00:00", "2024-01-09 00:00:00")
    assert whole.count() == 0
    ragged = R.over_range(R.read(spark, path, R.CONTENT).limit(0), dated, R.CONTENT, "2024-01-05 12:00:00", "2024-01-09 12:00:00")
    assert {str(r.event_date) for r in ragged.select("event_date").distinct().collect()} == {"2024-01-05", "2024-01-09"}


def test_the_fan_out_keeps_rollups(spark, events, tmp_path):
    """Every batch once, also if it is repeated; missing events are left out as in the table."""
    counters = str(tmp_path / "counters")
    assert set(job.counter_totals(spark, counters).values()) == {0}
    sink = job.FanOut(str(tmp_path / "table"), rollup_path=str(tmp_path / "rollups"), counters_path=counters)
    batch = events.withColumn("kind", F.lit("event")).withColumn("drained", F.lit(False))
    for number in (0, 1, 1):
        sink(batch.where(F.col("id") % 2 == number), number)
    kept = events.where("not content_missing")
    rows = R.read(spark, str(tmp_path / "rollups"), R.CONTENT)
    counted = {r.content_id: r.n for r in rows.groupBy("content_id").agg(F.sum("n_events").alias("n")).collect()}
    assert counted == {r.content_id: r["count"] for r in kept.groupBy("content_id").count().collect()}
    assert job.counter_totals(spark, counters)["enriched"] == kept.count()
