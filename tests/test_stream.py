import json
import time

import pytest
from pyspark.sql import functions as F

from pulsemill.functions.keys import event_json
from pulsemill.operators.asof import enrich_asof
from pulsemill.operators.counters import content_cache_size
from pulsemill.sinks import kv
from pulsemill.sources import changes
from pulsemill.sources.tables import read_warehouse
from pulsemill.streaming import job
from pulsemill.streaming.enrich import enrich_stream, first_seen, tagged_streams
from tests.test_asof import frames, recorded

TOPIC = "pgcdc.public."


class Feeds:
    """Two folders of JSON lines and a stream over them."""

    def __init__(self, spark, path, wait, hot_ids=(), hot_slices=3):
        self.spark, self.path = spark, path
        self.folders = {name: path / name for name in ("content", "engagement_events")}
        for folder in self.folders.values():
            folder.mkdir()
        self.files = 0
        self.seq = 0
        self.setup = (wait, hot_ids, hot_slices)
        self.collector = job.Collector(str(path / "out"))
        self.times = {}

    def start(self):
        engagement = changes.read_file_stream(
            self.spark, str(self.folders["engagement_events"]), TOPIC + "engagement_events")
        content = changes.read_file_stream(self.spark, str(self.folders["content"]), TOPIC + "content")
        output = job.build_stream(engagement, content, *self.setup)
        self.schema = output.schema

        def sink(batch, batch_id):
            self.times[batch_id] = time.time()
            self.collector(batch, batch_id)

        self.query = job.start(
            self.spark, output, sink, str(self.path / "checkpoint"), 0.2, state_partitions=2)
        self.consumed = 0

    def stop(self):
        self.query.stop()

    def write(self, *messages):
        """messages: (table, after-image or None); returns when they are consumed."""
        self.files += 1
        rows = {}
        for table, after in messages:
            self.seq += 1
            line = json.dumps({"before": None, "after": after, "source": {"lsn": self.seq}})
            rows.setdefault(table, []).append(line)
        for table, lines in rows.items():
            hidden = self.folders[table] / f".{self.files}"
            hidden.write_text("\n".join(lines) + "\n")
            hidden.rename(self.folders[table] / f"{self.files}.json")
        self.consumed += len(messages)
        self.until(lambda: sum(p.numInputRows for p in self.query.recentProgress) >= self.consumed)
        return time.time()

    def until(self, done, timeout=90):
        end = time.time() + timeout
        while not done():
            assert self.query.exception() is None, self.query.exception()
            assert time.time() < end, "timed out"
            time.sleep(0.05)

    def rows(self):
        return self.spark.read.schema(self.schema).option("basePath", self.collector.path).parquet(
            self.collector.path).withColumn(
            "batch", F.regexp_extract(F.input_file_name(), "batch_id=([0-9]+)", 1).cast("int"))


def content(key, kind="podcast", length=60):
    return "content", {"id": key, "slug": key, "title": key, "content_type": kind, "length_seconds": length}


def event(number, key, **unknown):
    return "engagement_events", {
        **unknown,
        "id": number, "content_id": key, "user_id": "u", "event_type": "play",
        "event_ts": "2024-01-15T10:30:00Z", "duration_ms": 30_000, "device": "ios", "raw_payload": "{}",
    }


def observed_totals(query):
    seen = [p.observedMetrics.get("enrichment") for p in query.recentProgress]
    return {k: sum(s[k] or 0 for s in seen if s) for k in job.COUNTED[:4]}


@pytest.mark.parametrize("hot_ids", [(), ("D",)])
def test_scripts(spark, tmp_path, hot_ids):
    wait = 8
    feeds = Feeds(spark, tmp_path, wait, hot_ids)
    feeds.start()
    try:
        feeds.write(content("A"), content("E", "video"), content("F"))
        feeds.write(("content", None), event(1, "A"), event(2, "B"), event(3, "C"), event(4, "D"),
                    event(5, "D"), event(6, "D"), event(7, "E"), event(8, "F", zz={"a": [1, "é"]}),
                    event(11, None))
        restarted = time.time()
        feeds.write(content("B"), content("E", "newsletter", None), event(9, "D"))
        feeds.write(event(10, "E"))
        feeds.until(lambda: feeds.collector.events >= 11)
        # The progress report follows the batch.
        expected = {"enriched": 5, "missing_content": 6, "new_items": 4, "flushed_pending": 1}
        feeds.until(lambda: observed_totals(feeds.query) == expected)
    finally:
        feeds.stop()
    rows = feeds.rows().collect()
    events = {r.id: r for r in rows if r.kind == "event"}
    assert len(events) == sum(r.kind == "event" for r in rows) == 11
    assert {i: r.content_type for i, r in events.items()} == {
        1: "podcast", 2: "podcast", 3: None, 4: None, 5: None, 6: None, 7: "video", 8: "podcast",
        9: None, 10: "newsletter", 11: None,
    }
    assert (events[1].engagement_seconds, events[1].engagement_pct) == (30.0, 50.0)
    assert events[10].engagement_seconds == 30.0 and events[10].engagement_pct is None
    unknown = feeds.rows().where("id = 8").select(F.to_json("extras"), event_json(feeds.rows())).first()
    assert unknown[0] == '{"zz":{"a":[1,"é"]}}' and unknown[1].endswith('"engagement_pct":50.0,"zz":{"a":[1,"é"]}}')
    assert {i for i, r in events.items() if r.drained} == {2}
    missing = {i for i, r in events.items() if r.content_missing}
    assert missing == {3, 4, 5, 6, 9, 11}
    assert all(events[i].engagement_seconds is None for i in missing)
    # Each event of D restarted the wait of them all, in every slice.
    last = {events[i].batch for i in (4, 5, 6, 9)}
    assert len(last) == 1 and feeds.times[last.pop()] >= restarted + wait
    assert sorted(r.content_id for r in first_seen(feeds.rows()).collect()) == ["A", "B", "E", "F"]


@pytest.mark.parametrize("hot_ids", [(), ("hot",)])
def test_stream_equals_batch_across_a_restart(spark, tmp_path, hot_ids):
    rounds, arrivals = [], []
    for seed in range(3):
        rows = recorded(seed, 240)
        # One kind per round: the order of a key's rows within a batch is free.
        for kind in ("main", "content"):
            rounds.append([r for r in rows if r[2] == kind])
    number = 0
    feeds = Feeds(spark, tmp_path, 10_000, hot_ids)
    feeds.start()
    try:
        for i, rows in enumerate(rounds):
            messages = []
            seen = set()
            for _, _, kind, key, value in rows:
                if kind == "content" and key in seen:
                    continue
                seen.add(key)
                number += 1
                value = number if kind == "main" else f"v{number}"
                arrivals.append((number, number, kind, key, value))
                messages.append(event(number, key) if kind == "main" else content(key, value))
            feeds.write(*messages)
            if i == 2:
                feeds.stop()
                feeds.start()
        ev, ver = frames(spark, arrivals)
        batch = enrich_asof(ev, ver)
        known = batch.where(~F.col("content_missing")).collect()
        found = {r.id: (r.content_type, r.drained) for r in known}
        feeds.until(lambda: feeds.collector.events >= len(found))
    finally:
        feeds.stop()
    rows = [r for r in feeds.rows().collect() if r.kind == "event"]
    assert {r.id: (r.content_type, r.drained) for r in rows} == found
    assert any(r.drained for r in rows) and not all(r.drained for r in rows)
    assert len(rows) == len(found) < sum(a[2] == "main" for a in arrivals)



def test_sliced_rows_keep_each_event_once(spark):
    ev, ver = frames(spark, recorded(1, 200))
    plain = tagged_streams(ev, ver)
    sliced = tagged_streams(ev, ver, ["hot"], 4)
    own = sliced.where("tag = 'main'")
    assert own.count() == plain.where("tag = 'main'").count() == ev.count()
    assert own.where("content_id = 'hot'").select("slice").distinct().count() == 4
    hot = ver.where("id = 'hot'").count()
    assert sliced.where("tag = 'content'").count() == ver.count() + 3 * hot


def test_enrich_stream_needs_no_watermark(spark, tmp_path):
    engagement = changes.engagement_changes(changes.read_file_stream(spark, str(tmp_path), "t"))
    catalogue = changes.content_changes(changes.read_file_stream(spark, str(tmp_path), "t"))
    plan = enrich_stream(engagement, catalogue)._jdf.queryExecution().analyzed().toString()
    assert "Watermark" not in plan


def test_running_number_of_items(spark, tmp_path):
    folder = tmp_path / "content"
    folder.mkdir()
    lines = [json.dumps({"after": {"id": f"c{i % 7}"}}) for i in range(20)]
    (folder / "1.json").write_text("\n".join(lines) + "\n")
    items = changes.content_changes(changes.read_file_stream(spark, str(folder), TOPIC + "content"))
    result = job.final_table(spark, content_cache_size(items), str(tmp_path / "work"), 2)
    assert result.first().cached_items == 7


def test_console_sink(spark, tmp_path):
    feeds = Feeds(spark, tmp_path, 10)
    (feeds.folders["content"] / "1.json").write_text(json.dumps({"after": {"id": "a"}}) + "\n")
    output = enrich_stream(
        changes.engagement_changes(changes.read_file_stream(
            spark, str(feeds.folders["engagement_events"]), TOPIC + "engagement_events")),
        changes.content_changes(changes.read_file_stream(
            spark, str(feeds.folders["content"]), TOPIC + "content")),
    )
    query = feeds.query = job.start_console(spark, output, str(tmp_path / "c"), 0.2)
    try:
        feeds.until(lambda: any(p.numInputRows == 1 for p in query.recentProgress))
    finally:
        query.stop()


def test_two_queries_share_one_table(spark, tmp_path):
    """Each with its own checkpoint: batch numbers meet, rows don't; counters add up."""
    table = str(tmp_path / "table")
    for run in range(2):
        home = tmp_path / f"run{run}"
        home.mkdir()
        feeds = Feeds(spark, home, wait=60)
        sink = job.FanOut(table, str(tmp_path / "kv"))
        feeds.collector = lambda batch, batch_id, sink=sink: sink(batch, batch_id)
        feeds.start()
        try:
            feeds.write(content("A"), *[event(10 * run + i, "A") for i in range(5)])
            feeds.write(*[event(10 * run + 5 + i, "A") for i in range(3)])
            done = 8 * (run + 1)
            feeds.until(lambda: (tmp_path / "table-counters").exists()
                        and job.counter_totals(spark, f"{table}-counters")["enriched"] == done)
        finally:
            feeds.stop()
    rows = read_warehouse(spark, table)
    assert sorted(r.id for r in rows.collect()) == [*range(8), *range(10, 18)]
    assert rows.select("writer").distinct().count() == 2
    assert kv.read_log(spark, str(tmp_path / "kv")).count() == 16
    totals = job.counter_totals(spark, f"{table}-counters")
    del totals["flushed_pending"]  # content and events of one batch come in any order
    assert totals == {"enriched": 16, "missing_content": 0, "new_items": 2, "rejected": 0, "failed_sinks": 0}


def test_hot_ids_are_fixed_by_the_first_start(spark, tmp_path):
    feeds = Feeds(spark, tmp_path, 60)
    feeds.start()
    feeds.stop()
    feeds.start()  # the same again
    feeds.stop()
    feeds.setup = (60, ("A",), 3)
    with pytest.raises(ValueError, match="new checkpoint"):
        feeds.start()


def test_bad_messages_are_kept(spark, tmp_path):
    folder = tmp_path / "engagement_events"
    folder.mkdir()
    good = json.dumps({"after": event(1, "A")[1]})
    (folder / "1.json").write_text(good + "\nnot json\n" + json.dumps({"op": "x"}) + "\n")
    other = tmp_path / "content"
    other.mkdir()
    (other / "1.json").write_text(json.dumps({"after": None}) + "\n")
    bad = job.quarantine_stream(
        changes.read_file_stream(spark, str(folder), TOPIC + "engagement_events"),
        changes.read_file_stream(spark, str(other), TOPIC + "content"))
    for _ in range(2):  # the second run finds nothing new
        job.start_quarantine(bad, str(tmp_path / "bad"), str(tmp_path / "check"), None).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.reason for r in found) == ["delete", "invalid_json", "no_after"]


def test_a_long_batch_is_not_idle(spark, tmp_path):
    """A replay gives up if nothing happens, not if a batch takes its time."""
    for table, message in (content("A"), event(1, "A")):
        (tmp_path / table).mkdir()
        (tmp_path / table / "1.json").write_text(json.dumps({"before": None, "after": message}) + "\n")
    output = job.build_stream(*[
        changes.read_file_stream(spark, str(tmp_path / t), TOPIC + t) for t in ("engagement_events", "content")])
    rows = job.replay(spark, output, 1, str(tmp_path / "run"), 2, idle_secs=10, also=lambda batch, n: time.sleep(12))
    assert [r.drained for r in rows.where("kind = 'event'").collect()] == [False]
    collector = job.Collector("nowhere", idle_secs=1)
    time.sleep(1.1)
    assert collector.idle_secs() > 1


def test_content_of_a_batch_comes_before_its_events(spark, tmp_path):
    """Events of content that comes in the same batch pass through no waiting list."""
    feeds = Feeds(spark, tmp_path, 8)
    for table, lines in (("engagement_events", [event(i, "A")[1] for i in range(300)]), ("content", [content("A")[1]])):
        (feeds.folders[table] / "1.json").write_text("".join(
            json.dumps({"before": None, "after": a, "source": {"lsn": 1}}) + "\n" for a in lines))
    feeds.start()
    try:
        feeds.until(lambda: feeds.collector.events >= 300)
    finally:
        feeds.stop()
    assert feeds.rows().where("kind = 'event' and not drained and content_type = 'podcast'").count() == 300
