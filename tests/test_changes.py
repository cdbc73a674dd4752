import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsemill.functions import envelopes as E
from pulsemill.sources import changes

CASES = [
    ('{"before":null,"after":{"id":1,"d":2}}', {"id": 1, "d": 2}, None),
    ('{"schema":{},"payload":{"before":null,"after":{"id":2,"d":3}}}', {"id": 2, "d": 3}, None),
    ('{"payload":{"after":{"id":7,"zz":1}}}', {"id": 7, "zz": 1}, None),
    ('{"before":{"id":1},"after":null}', None, E.DELETE),
    ('{"payload":{"before":{"id":1},"after":null}}', None, E.DELETE),
    ('{"after":null,"payload":{"after":{"id":9}}}', None, E.DELETE),
    ('{"payload":null}', None, E.NO_AFTER),
    ('{"payload":[1]}', None, E.NO_AFTER),
    ('{"payload":"x"}', None, E.NO_AFTER),
    ('{"foo":1}', None, E.NO_AFTER),
    ("null", None, E.NO_AFTER),
    ("[1]", None, E.NO_AFTER),
    ("not json", None, E.INVALID_JSON),
    ('{"after":{"id":1}', None, E.INVALID_JSON),
    ("", None, E.INVALID_JSON),
    ('{"after":{"t":"é \\"q\\""}}', {"t": 'é "q"'}, None),
]


def test_after_image_of_every_shape(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "value string")
    got = {r.value: (r.after and json.loads(r.after), r.reason) for r in E.with_after_image(df).collect()}
    assert got == {value: (after, reason) for value, after, reason in CASES}


def test_bytes_are_decoded(spark):
    df = spark.createDataFrame([(bytearray('{"after":{"t":"é"}}', "utf-8"),)], "value binary")
    assert json.loads(E.with_after_image(df).first().after) == {"t": "é"}


def event(**fields):
    base = {
        "id": 1, "content_id": "c", "user_id": "u", "event_type": "play",
        "event_ts": "2024-01-15T10:30:00Z", "duration_ms": 1, "device": "ios", "raw_payload": "{}",
    }
    return json.dumps({"before": None, "after": {**base, **fields}})


def feed(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("text, instant", [
    ("2024-01-15T10:30:00Z", "2024-01-15 10:30:00"),
    ("2024-01-15T12:30:00+02:00", "2024-01-15 10:30:00"),
    ("2024-01-15T10:30:00.123456Z", "2024-01-15 10:30:00.123456"),
    ("2024-01-15T10:30:00", "2024-01-15 10:30:00"),
])
def test_event_time_forms(spark, text, instant):
    rows = changes.engagement_changes(feed(spark, event(event_ts=text)))
    assert rows.select(F.col("event_ts").cast("string")).first()[0] == instant


def test_rows_without_id_or_time_are_quarantined(spark):
    parsed = changes.parse_engagement(feed(
        spark, event(), event(event_ts="soon"), event(id=None), '{"after":5}', "oops"
    ))
    reasons = sorted(r.reason for r in changes.quarantined(parsed).collect())
    assert reasons == [E.BAD_ROW] * 3 + [E.INVALID_JSON]
    assert changes.usable(parsed).count() == 1


def test_nothing_is_lost_between_usable_and_quarantined(spark):
    values = [event(id=i) if i % 3 else "broken" for i in range(100)]
    parsed = changes.parse_engagement(feed(spark, *values))
    assert changes.usable(parsed).count() + changes.quarantined(parsed).count() == 100


def test_content_gets_a_default_publish_time(spark):
    rows = changes.content_changes(feed(
        spark, '{"after":{"id":"a","slug":"s","title":"t"}}',
        '{"after":{"id":"b","publish_ts":"2024-02-01T00:00:00Z"}}',
    ))
    got = {r.id: r.publish_ts for r in rows.collect()}
    assert got["a"].date() == dt.date(2024, 1, 1) and got["b"].date() == dt.date(2024, 2, 1)


def test_unknown_fields_are_kept_on_request(spark):
    row = changes.engagement_changes(feed(spark, event(zz={"a": [1]})), keep_extras=True)
    assert row.select(F.to_json("extras")).first()[0] == '{"zz":{"a":[1]}}'


def test_messages_are_parsed_once(spark):
    parsed = changes.quarantined(changes.parse_engagement(feed(spark, event())))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 3  # message, payload, after-image


def test_topics(spark):
    rows = [("pgcdc.public.content",), ("pgcdc.public.engagement_events",), ("pgcdc.audit.x",), ("other",)]
    df = spark.createDataFrame(rows, "topic string")
    tables = sorted(r.table for r in changes.routed(changes.include(df)).collect())
    assert tables == ["content", "engagement_events"]


def test_kafka_options_bound_a_batch():
    options = changes.kafka_options("broker:9092", maxOffsetsPerTrigger="1000000")
    assert options["subscribePattern"] == r"^pgcdc\.public\..*$"
    assert options["maxOffsetsPerTrigger"] == "1000000"


def test_a_feed_has_one_kind_of_position(spark):
    df = feed(spark, '{"after":{},"ts_ms":5,"source":{"lsn":9}}', '{"payload":{"after":{},"ts_ms":5}}', "x")
    assert [r[0] for r in df.select(E.feed_position(F.col("value"))).collect()] == [9, None, None]
    by_time = df.select(E.feed_position(F.col("value"), E.TIME_POSITION)).collect()
    assert [r[0] for r in by_time] == [5, 5, None]
