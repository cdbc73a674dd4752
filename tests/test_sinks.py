import http.client
import json

import pytest
from pyspark.sql import functions as F

from pulsemill.functions.timefuncs import between, last_days, on_date, since_date
from pulsemill.operators.counters import observed, receipt_counts
from pulsemill.operators.enrich import enrich_snapshot
from pulsemill.schemas import ENRICHED, load_schema
from pulsemill.sinks import delivery, kv, warehouse
from pulsemill.sources.tables import read_warehouse
from pulsemill.streaming.enrich import KIND_EVENT
from pulsemill.streaming.job import FanOut
from tests.test_enrich import CONTENT, events


@pytest.fixture(scope="module")
def enriched(spark):
    catalogue = spark.createDataFrame(
        [(f"c{k}", ("podcast", "video")[k % 2], 100) for k in range(4)], CONTENT)
    facts = events(spark, [(i, f"c{i % 5}", i * 10) for i in range(200)])
    facts = facts.withColumn(
        "event_ts", F.expr("timestamp '2024-01-01 23:00:00' + make_dt_interval(0, cast(id as int))"))
    return enrich_snapshot(facts, catalogue).cache()


def test_warehouse_keeps_known_content_only(enriched):
    rows, rejects = warehouse.warehouse_rows(enriched)
    assert rows.count() == 160 and rejects.count() == 0
    assert rows.columns == ENRICHED.fieldNames()
    assert rows.schema["engagement_pct"].metadata["comment"]
    assert warehouse.warehouse_rows(enriched, include_missing=True)[0].count() == 200


def test_rejects_name_the_missing_columns(spark, enriched):
    broken = enriched.withColumn("device", F.when(F.col("id") != 3, F.col("device")))
    rows, rejects = warehouse.warehouse_rows(broken)
    assert [(r.id, r.missing) for r in rejects.collect()] == [(3, ["device"])]
    assert rows.count() == 159


@pytest.mark.parametrize("rebalance", [True, False])
def test_repeated_batch_replaces_itself(spark, enriched, tmp_path, rebalance):
    path = str(tmp_path / "w")
    rows, _ = warehouse.warehouse_rows(enriched)
    warehouse.write_batch(rows.where("id < 100"), path, 0, rebalance)
    warehouse.write_batch(rows.where("id < 150"), path, 1, rebalance)  # a failed try
    warehouse.write_batch(rows.where("id >= 100"), path, 1, rebalance)
    table = read_warehouse(spark, path)
    assert table.count() == 160 and table.select("id").distinct().count() == 160
    assert {r[0] for r in table.groupBy("event_date", F.to_date("event_ts").alias("d")).count()
            .where("event_date = d").select("event_date").collect()} == \
        {r[0] for r in rows.select(F.to_date("event_ts")).distinct().collect()}
    warehouse.write_batch(rows.where("id < 10"), path, 1, rebalance, writer="another query")
    assert read_warehouse(spark, path).count() == 160 + rows.where("id < 10").count()
    target = str(tmp_path / "c")
    warehouse.write_batch(rows, target, 0, rebalance)
    warehouse.compact(spark, path, target, first_date="2024-01-03")
    later = read_warehouse(spark, path).where("event_date >= date'2024-01-03'").count()
    assert later > 0 and read_warehouse(spark, target).count() == 160 + later


def test_one_day_lists_its_own_folders(spark, enriched, tmp_path):
    path = str(tmp_path / "w")
    warehouse.write_batch(warehouse.warehouse_rows(enriched)[0], path, 0)
    dates = {p.name for p in (tmp_path / "w").iterdir() if p.is_dir()}
    assert dates and all(d.startswith("event_date=") for d in dates)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_ranges_are_utc_in_every_session_zone(spark, enriched, tmp_path, zone):
    path = str(tmp_path / "w")
    warehouse.write_batch(warehouse.warehouse_rows(enriched)[0], path, 0)
    micros = [r[0] for r in enriched.where("not content_missing").select(F.unix_micros("event_ts")).collect()]
    day = 86_400_000_000
    start = 1_704_240_000_000_000  # 2024-01-03 00:00 UTC

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for table in (read_warehouse(spark, path), read_warehouse(spark, path).drop("event_date")):
            assert on_date(table, "2024-01-03").count() == sum(start <= m < start + day for m in micros)
            assert since_date(table, 1, "2024-01-04").count() == sum(m >= start for m in micros)
            assert between(table, "2024-01-03 06:00:00", "2024-01-04 05:00:00").count() == sum(
                start + day // 4 <= m <= start + day + 5 * day // 24 for m in micros)
            assert last_days(table, 2, "2024-01-05 12:00:00").count() == sum(
                start + day // 2 <= m <= start + 5 * day // 2 for m in micros)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_ranges_prune_folders(spark, enriched, tmp_path):
    path = str(tmp_path / "w")
    warehouse.write_batch(warehouse.warehouse_rows(enriched)[0], path, 0)
    table = read_warehouse(spark, path)
    for df in (between(table, "2024-01-03 00:00:00", "2024-01-04 00:00:00"),
               last_days(table, 2, "2024-01-05 12:00:00")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "event_date" in partition_filters
        assert "GreaterThanOrEqual(event_ts" in plan.split("PushedFilters: [")[1]
    rows = between(table, "2024-01-02 00:00:00", "2024-01-02 01:00:00").collect()
    assert sorted(r.id for r in rows) == [1, 2]  # both ends count


def test_catalog_table(spark, enriched):
    spark.sql("DROP TABLE IF EXISTS enriched_events")
    rows, _ = warehouse.warehouse_rows(enriched)
    warehouse.append_table(rows.where("id < 50"), "enriched_events")
    warehouse.append_table(rows.where("id >= 50"), "enriched_events")
    assert spark.table("enriched_events").count() == 160
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE enriched_events").collect()}
    assert described["engagement_pct"] and described["event_date"]
    assert spark.sql("SHOW TBLPROPERTIES enriched_events('written_by')").first()["value"] == "pulsemill"
    spark.sql("DROP TABLE enriched_events")


def test_schema_file(tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps([
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED", "description": "key"},
        {"name": "x", "type": "FLOAT"},
    ]))
    schema = load_schema(str(path))
    assert schema.simpleString() == "struct<id:bigint,x:double>"
    assert not schema["id"].nullable and schema["x"].nullable
    with pytest.raises(FileNotFoundError):
        load_schema(str(tmp_path / "none.json"))
    path.write_text("[")
    with pytest.raises(json.JSONDecodeError):
        load_schema(str(path))


def test_kv_document(enriched):
    pairs = {r.key: r.value for r in kv.kv_pairs(enriched).collect()}
    assert len(pairs) == 200
    assert pairs["eng:{c1}:1"] == (
        '{"id":1,"content_id":"c1","user_id":"u","event_type":"play",'
        '"event_ts":"2024-01-02T00:00:00.000000Z","duration_ms":10,"device":"ios","raw_payload":"{}",'
        '"content_type":"video","length_seconds":100,"engagement_seconds":0.01,"engagement_pct":0.01}'
    )
    assert json.loads(pairs["eng:{c4}:4"])["_content_missing"] is True
    assert "content_type" not in pairs["eng:{c4}:4"]


def test_kv_keeps_unknown_fields_and_newest_copy(spark, enriched):
    one = enriched.where("id = 1").withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    one = one.withColumn("extras", F.from_json(F.format_string('{"zz":%d}', "seq"), "map<string,variant>"))
    row = kv.kv_pairs(one, ["seq"]).first()
    assert json.loads(row.value)["zz"] == 2


def test_kv_upsert_and_expiry(spark, tmp_path):
    path = str(tmp_path / "kv")

    def pairs(**entries):
        return spark.createDataFrame(list(entries.items()), "key string, value string")

    kv.write_batch(pairs(a="1", b="1", c="1"), path, 0, "2024-01-01 00:00:00", 3600)
    kv.write_batch(pairs(a="2"), path, 1, "2024-01-01 00:30:00", 3600)
    kv.write_batch(pairs(b="2"), path, 2, "2024-01-01 00:30:00", None)
    kv.write_batch(pairs(c="2"), path, 3, "2024-01-01 00:30:00", 60)
    log = kv.read_log(spark, path)

    def live(as_of, ttl=None):
        return {r.key: r.value for r in kv.live_entries(log, as_of, ttl).collect()}

    assert live("2024-01-01 00:10:00") == {"a": "1", "b": "1", "c": "1"}
    assert live("2024-01-01 00:30:30") == {"a": "2", "b": "2", "c": "2"}
    # c was written again with a shorter life: its older write must not come back.
    assert live("2024-01-01 00:45:00") == {"a": "2", "b": "2"}
    assert live("2024-01-01 01:30:00") == {"b": "2"}
    assert kv.get(log, "a", "2024-01-01 00:45:00").first().value == "2"
    assert kv.get(log, "a", "2024-01-01 02:00:00").count() == 0
    assert kv.keys_with_prefix(log, "a", "2024-01-01 00:45:00").count() == 1
    assert kv.size(log, "2024-01-01 00:45:00").first().n_keys == 2
    kv.write_batch(pairs(a="2"), path, 1, "2024-01-01 00:30:00", 3600)
    assert kv.size(kv.read_log(spark, path), "2024-01-01 00:45:00").first().n_keys == 2


def test_longest_life_prunes_old_folders(spark, tmp_path):
    path = str(tmp_path / "kv")
    df = spark.createDataFrame([("a", "1")], "key string, value string")
    kv.write_batch(df, path, 0, "2024-01-01 00:00:00")
    kv.write_batch(df, path, 1, "2024-01-05 00:00:00")
    kv.write_batch(df.withColumn("key", F.lit("kept")), path, 2, "2024-01-01 00:00:00", None)
    live = kv.live_entries(kv.read_log(spark, path), "2024-01-05 00:10:00", kv.DEFAULT_TTL_SECS)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "written_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.key for r in live.collect()} == {"a", "kept"}
    assert kv.purge(spark, path, "2024-01-05") == 1
    log = kv.read_log(spark, path)
    assert {r.key for r in kv.live_entries(log, "2024-01-05 00:10:00").collect()} == {"a", "kept"}
    assert log.count() == 2
    one = kv.get(log, "a", "2024-01-05 00:10:00")
    assert one.count() == 1
    assert "bucket" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_counting_keys_reads_no_values(spark, tmp_path):
    path = str(tmp_path / "kv")
    kv.write_batch(spark.createDataFrame([("a", "1")], "key string, value string"), path, 0)
    plan = kv.size(kv.read_log(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:string,written_at:timestamp,expires_at:timestamp>" in plan


class Store:
    def set(self, key, value, ttl_secs):
        assert ttl_secs == 60 and json.loads(value)
        if key.endswith("7"):
            raise ConnectionError("down")

    def close(self):
        pass


def test_failing_writes_are_counted(enriched):
    receipts = kv.push(kv.kv_pairs(enriched), Store, 60)
    assert {r.status: r.events for r in receipt_counts(receipts).collect()} == {"ok": 180, "error": 20}


class Receiver:
    """Answers by rule: accepts, refuses, is down, is slow, recovers."""

    def __init__(self, rule):
        self.rule, self.calls = rule, 0

    def post(self, body):
        self.calls += 1
        assert isinstance(json.loads(body)["events"], list)
        if self.rule == "down":
            raise ConnectionError("refused")
        if self.rule == "slow":
            raise TimeoutError("slow")
        if self.rule == "bug":
            raise ValueError("bug")
        if self.rule == "recovers":
            return 200 if self.calls % 2 == 0 else 503
        return {"ok": 200, "refuses": 422, "broken": 500}[self.rule]

    def close(self):
        pass


@pytest.mark.parametrize("rule, status, error_class, attempts", [
    ("ok", "ok", None, 1), ("recovers", "ok", None, 2), ("refuses", "error", "http", 1),
    ("broken", "error", "http", 3), ("down", "error", "connection", 3),
    ("slow", "error", "timeout", 3), ("bug", "error", "other", 1),
])
def test_receipts(enriched, rule, status, error_class, attempts):
    documents = delivery.local_batches(enriched.coalesce(1), 60)
    receipts = delivery.send(documents, lambda: Receiver(rule), pause_secs=0.0).collect()
    assert [r.n_events for r in receipts] == [60, 60, 60, 20]
    assert {(r.status, r.error_class, r.attempts) for r in receipts} == {(status, error_class, attempts)}


@pytest.mark.parametrize("make", [
    lambda df: delivery.local_batches(df, 7), lambda df: delivery.numbered_batches(df, "id", 7)])
def test_every_event_is_in_one_document(enriched, make):
    documents = make(enriched.repartition(5))
    assert documents.agg(F.max("n_events")).first()[0] <= 7
    ids = [r.id for r in delivery.events_of(documents, ENRICHED).collect()]
    assert sorted(ids) == list(range(200))


def test_numbered_documents_are_ordered(enriched):
    body = delivery.numbered_batches(enriched.repartition(3), "id", 50).where("batch_no = 1").first().body
    assert [e["id"] for e in json.loads(body)["events"]] == list(range(50, 100))


def batch(enriched):
    kind, drained = F.lit(KIND_EVENT), F.lit(False)
    return enriched.withColumns({"kind": kind, "seq": F.col("id"), "drained": drained})


def test_fan_out_feeds_every_sink_once(spark, enriched, tmp_path):
    sink = FanOut(
        str(tmp_path / "w"), str(tmp_path / "kv"), rejects_path=str(tmp_path / "r"),
        make_kv_client=Store, kv_ttl_secs=60, kv_receipts_path=str(tmp_path / "kv_receipts"),
        make_transport=lambda: Receiver("ok"), receipts_path=str(tmp_path / "receipts"),
        delivery_batch_size=50,
    )
    for _ in range(2):  # the second run is the repetition after a failure
        sink(batch(enriched), 0)
    assert read_warehouse(spark, str(tmp_path / "w")).count() == 160
    assert kv.read_log(spark, str(tmp_path / "kv")).count() == 200
    assert spark.read.parquet(str(tmp_path / "kv_receipts")).agg(F.sum("n_events")).first()[0] == 200
    counts = receipt_counts(spark.read.parquet(str(tmp_path / "receipts"))).first()
    assert (counts.sink, counts.status, counts.events) == ("http", "ok", 200)


def test_optional_sinks_do_not_stop_the_others(spark, enriched, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    sink = FanOut(
        str(tmp_path / "w"), str(blocked / "kv"),
        make_transport=lambda: Receiver("down"), receipts_path=str(tmp_path / "receipts"),
    )
    sink(batch(enriched), 0)
    assert read_warehouse(spark, str(tmp_path / "w")).count() == 160
    assert spark.read.parquet(str(tmp_path / "receipts")).where("status = 'error'").count() > 0
    with pytest.raises(Exception):
        FanOut(str(blocked / "w"))(batch(enriched), 0)


def test_outcomes_are_observed_in_batch(enriched):
    df, watch = observed(enriched)
    df.write.format("noop").mode("overwrite").save()
    assert watch.get == {"enriched": 160, "missing_content": 40}


class Line:
    """Stands in for a connection: answers 200, 503, then drops the line once."""

    opened, sent = 0, []

    def __init__(self, host, port=None, timeout=None):
        Line.opened += 1
        self.to = (host, port, timeout)

    def request(self, method, path, body, headers):
        Line.sent.append((*self.to, method, path, body, headers["Content-Type"]))
        if len(Line.sent) == 3:
            raise http.client.RemoteDisconnected("gone")

    def getresponse(self):
        reply = type("Reply", (), {"status": 503 if len(Line.sent) == 2 else 200, "read": lambda _: b""})
        return reply()

    def close(self):
        pass


def test_http_transport_keeps_its_connection(monkeypatch):
    monkeypatch.setattr(http.client, "HTTPConnection", Line)
    transport = delivery.HttpTransport("http://receiver:1/", 30)
    assert [transport.post('{"events":[]}') for _ in range(4)] == [200, 503, 200, 200]
    assert Line.opened == 2 and len(Line.sent) == 5
    assert Line.sent[0] == ("receiver", 1, 30, "POST", "/events", b'{"events":[]}', "application/json")
    transport.close()


def test_receipts_need_a_folder():
    with pytest.raises(ValueError):
        FanOut("w", make_transport=lambda: Receiver("ok"))
    with pytest.raises(ValueError):
        FanOut("w", make_kv_client=Store)
