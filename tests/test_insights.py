import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemill.plans import insights

SCHEMA = (
    "id long, content_id string, user_id string, event_type string, event_ts timestamp, device string, "
    "content_type string, length_seconds long, engagement_seconds double, engagement_pct double"
)


def at(day, hour=12):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (1, "a", "u1", "play", at(30), "ios", "podcast", 100, 50.0, 50.0),
        (2, "a", "u1", "play", at(30), "ios", "podcast", 100, 90.0, 90.0),
        (3, "b", "u1", "click", at(30), "android", "newsletter", None, None, None),
        (4, "c", "u2", "play", at(24, 0), "ios", "video", 50, 75.0, 150.0),
        (5, "c", "u2", "play", at(31, 0), "ios", "video", 50, 5.0, 10.0),
        (6, "d", "u3", "play", at(1), "android", "video", 0, 30.0, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_day_query_leaves_rows_without_share_out(table):
    rows = insights.engagement_by_content_type(table, "2024-01-30").collect()
    assert [(r.content_type, r.total_events, r.avg_engagement_pct) for r in rows] == [("podcast", 2, 70.0)]


def test_both_ends_of_a_range_count(table):
    rows = insights.type_device_engagement(table, "2024-01-31 00:00:00", 7).collect()
    assert {(r.content_type, r.device): r.avg_engagement_pct for r in rows} == {
        ("podcast", "ios"): 70.0, ("newsletter", "android"): None, ("video", "ios"): 80.0}


def test_date_ranges_start_at_midnight(table):
    def ids(today, days):
        rows = insights.user_engagement_patterns(table, today, days, min_events=1).collect()
        return [r.user_id for r in rows]

    assert ids("2024-01-31 18:00:00", 7) == ["u2", "u1"]
    assert ids("2024-02-01 00:00:00", 7) == ["u1", "u2"]


def test_having_and_order(table):
    rows = insights.content_performance(table, "2024-01-31", min_plays=2).collect()
    assert [(r.content_id, r.play_events, r.high_engagement_users) for r in rows] == [("c", 2, 1), ("a", 2, 1)]


def test_single_rows_have_no_spread(table):
    rows = insights.device_variability(table, "2024-01-30 12:00:00", 0).collect()
    assert {r.device: r.stddev_engagement_pct for r in rows}["ios"] == pytest.approx(28.28427, abs=1e-4)
    one = insights.device_variability(table.where("id = 1"), "2024-01-31").first()
    assert one.stddev_engagement_pct is None


def test_best_content_of_users_without_share_is_null(table):
    rows = insights.most_engaging_content_per_user(table, "2024-01-01", "2024-01-31").collect()
    assert {r.user_id: r.most_engaging_content for r in rows} == {"u1": "a", "u2": "c", "u3": None}


def test_percentiles(table):
    p90 = {r.content_type: r[1] for r in insights.p90_seconds_by_type(table, "2024-01-31").collect()}
    assert p90 == {"podcast": 90.0, "newsletter": None, "video": 75.0}
    median = insights.median_seconds_of_engaged(table, "2024-01-31").collect()
    assert {r.content_type: r[1] for r in median} == {"podcast": 90.0, "video": 75.0}


def test_tops(table):
    assert insights.top_device(table, "2024-01-31").first().device == "ios"
    rows = insights.top_content_on_device(table, "ios", "2024-01-31", top=1).collect()
    assert [r.content_id for r in rows] == ["a"]
    ranked = insights.top_types_per_device(table, "2024-01-31", top=1).collect()
    assert {(r.device, r.content_type) for r in ranked} == {("ios", "video"), ("android", "newsletter")}


def test_recent_and_counts(table):
    assert [r.id for r in insights.recent_events(table, 3).collect()] == [5, 3, 2]
    assert insights.total_events(table).first().total_events == 6
    counts = insights.source_counts(table.limit(2), table).collect()
    assert {r.source_table: r.n_rows for r in counts} == {"content": 2, "engagement_events": 6}


def test_now_is_the_default_end(spark, table):
    fresh = table.withColumn("event_ts", F.current_timestamp() - F.expr("INTERVAL 1 HOUR"))
    assert insights.p90_seconds_by_type(fresh).count() == 3
    assert insights.top_device(table).count() == 0
    naive = fresh.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    assert insights.p90_seconds_by_type(naive).count() == 3


def test_filters_reach_the_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    df = insights.top_device(spark.read.parquet(str(tmp_path / "t")), "2024-01-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,play)" in plan and "LessThanOrEqual(event_ts" in plan
    assert "ReadSchema: struct<event_type:string,event_ts:timestamp,device:string,engagement_seconds:double>" in plan
    assert "TakeOrderedAndProject" in plan
