"""The bucketed state machine: alone, against one arrival at a time, and in a stream."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsemill.operators.asof import enrich_asof
from pulsemill.session import STATE_SETTINGS, temporary_conf
from pulsemill.sources import changes
from pulsemill.streaming import buckets as B
from pulsemill.streaming import job
from tests.test_asof import simulate, with_deletes
from tests.test_stream import TOPIC, Feeds, content, event


class Handle:
    """State, list and timers in memory."""

    def __init__(self):
        self.value, self.rows, self.timers = None, [], set()

    def getValueState(self, name, schema, ttl=None):
        return Value(self)

    def getListState(self, name, schema):
        return Rows(self)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Value:
    def __init__(self, handle):
        self.handle = handle

    def get(self):
        return self.handle.value

    def update(self, value):
        self.handle.value = value

    def clear(self):
        self.handle.value = None


class Rows:
    def __init__(self, handle):
        self.handle = handle

    def get(self):
        return iter(list(self.handle.rows))

    def put(self, rows):
        self.handle.rows = list(rows)

    def appendList(self, rows):
        self.handle.rows += rows

    def clear(self):
        self.handle.rows = []


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


KIND_TAGS = {"main": B.EVENT, "content": B.CONTENT, "deleted": B.DELETED}


def run(arrivals, wait, ttl, batch):
    """All ids in one bucket; arrivals of ``batch`` rows come together, at their last time."""
    handle = Handle()
    machine = B.BucketLookup(wait, ttl, in_order=True)
    machine.init(handle)
    out = {}

    def keep(frames):
        for frame in frames:
            for r in frame.itertuples():
                if r.kind == "event":
                    assert r.event not in out and r.found == (r.attributes is not None)
                    out[r.event] = (r.attributes, r.drained)

    def fire(before):
        while due := [t for t in handle.timers if t < before]:
            handle.timers.remove(min(due))
            keep(machine.handleExpiredTimer((0, 0), Clock(min(due)), Clock(min(due))))

    for i in range(0, len(arrivals), batch):
        rows = arrivals[i:i + batch]
        at = rows[-1][1]
        fire(at * 1000)
        random.Random(i).shuffle(rows)
        frame = pd.DataFrame({
            "bucket": 0, "slice": 0, "content_id": [r[3] for r in rows], "tag": [KIND_TAGS[r[2]] for r in rows],
            "at": [r[0] for r in rows], "payload": [r[4] for r in rows]}).astype({"payload": object})
        keep(machine.handleInputRows((0, 0), iter([frame]), Clock(at * 1000)))
    fire(1 << 60)
    assert not handle.rows
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("wait, ttl", [(10_000, None), (10, None), (10, 25)])
def test_one_arrival_at_a_time(seed, wait, ttl):
    arrivals = with_deletes(seed)
    assert run(arrivals, wait, ttl, 1) == simulate(arrivals, wait, ttl)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("batch", [7, 100, 10_000])
def test_batches_in_order(seed, batch):
    """Within a long wait the cut into batches changes nothing."""
    arrivals = with_deletes(seed)
    assert run(arrivals, 100_000, None, batch) == simulate(arrivals, 100_000)


def test_lifetime_is_not_shorter_than_the_wait():
    with pytest.raises(ValueError):
        B.BucketLookup(10, 5)


class BucketFeeds(Feeds):
    """The bucketed stream over two folders."""

    options: dict = {}

    def start(self):
        engagement = changes.read_file_stream(
            self.spark, str(self.folders["engagement_events"]), TOPIC + "engagement_events")
        catalogue = changes.read_file_stream(self.spark, str(self.folders["content"]), TOPIC + "content")
        wait, hot_ids, hot_slices = self.setup
        output = job.build_bucket_stream(engagement, catalogue, wait, hot_ids, hot_slices, buckets=4, **self.options)
        self.schema = output.schema

        def sink(batch, batch_id):
            self.times[batch_id] = time.time()
            self.collector(batch, batch_id)

        self.query = job.start(
            self.spark, output, sink, str(self.path / "checkpoint"), 0.2, state_partitions=2)
        self.consumed = 0

    def delete(self, key):
        line = f'{{"before": {{"id": "{key}"}}, "after": null, "op": "d", "source": {{"lsn": {self.seq + 1}}}}}'
        self.seq += 1
        self.files += 1
        hidden = self.folders["content"] / f".{self.files}"
        hidden.write_text(line + "\n")
        hidden.rename(self.folders["content"] / f"{self.files}.json")
        self.consumed += 1
        self.until(lambda: sum(p.numInputRows for p in self.query.recentProgress) >= self.consumed)


def test_deletes_restart_and_the_next_layout(spark, tmp_path):
    """Deletes; a restart; then another checkpoint with a hot id, from what the first one knew."""
    feeds = BucketFeeds(spark, tmp_path, 600)
    feeds.options = {"deletes": True}
    feeds.start()
    try:
        feeds.write(content("A"), content("B", "video"), content("C"))
        feeds.write(event(1, "A"), event(2, "B"), event(3, "D"))
        feeds.delete("A")
        feeds.write(event(4, "A"), event(5, "B"))
        feeds.stop()
        feeds.start()
        feeds.write(event(6, "B"), event(7, "A"))
        feeds.write(content("A", "newsletter", None))
        feeds.write(event(8, "A", zz=1), event(9, "E"))
        feeds.delete("C")
        feeds.until(lambda: feeds.collector.events >= 7)
    finally:
        feeds.stop()
    events = {r.id: r for r in feeds.rows().collect() if r.kind == "event"}
    assert {i: (r.content_type, r.drained) for i, r in events.items()} == {
        1: ("podcast", False), 2: ("video", False), 4: ("newsletter", True), 5: ("video", False),
        6: ("video", False), 7: ("newsletter", True), 8: ("newsletter", False)}
    checkpoint = str(tmp_path / "checkpoint")
    with temporary_conf(spark, STATE_SETTINGS):
        known = {(r.id, r.content_type, r.length_seconds) for r in B.known_content(spark, checkpoint).collect()}
        assert known == {("A", "newsletter", None), ("B", "video", 60)}
        assert sorted(r.content_id for r in B.waiting_events(spark, checkpoint).collect()) == ["D", "E"]
        assert {r.content_id for r in B.next_flushes(spark, checkpoint).collect()} == {"D", "E"}

    other = tmp_path / "other"
    other.mkdir()
    more = BucketFeeds(spark, other, 600, ("B", "D"), 3)
    feeds.setup = (600, ("B", "D"), 3)
    with pytest.raises(ValueError, match="carried_over"):
        feeds.start()
    with temporary_conf(spark, STATE_SETTINGS):
        path = str(tmp_path / "initial")
        B.carried_over(spark, checkpoint, ("B", "D"), 3, 4).write.parquet(path)
    more.options = {"deletes": True, "initial": spark.read.parquet(path)}
    more.start()
    try:
        more.write(*[event(20 + i, "B") for i in range(9)], event(40, "A"), event(41, "C"))
        more.write(content("D"), content("E", "video"))
        more.until(lambda: more.collector.events >= 12)
    finally:
        more.stop()
    later = {r.id: (r.content_type, r.drained) for r in more.rows().collect() if r.kind == "event"}
    assert later == {**{20 + i: ("video", False) for i in range(9)}, 40: ("newsletter", False),
                     3: ("podcast", True), 9: ("video", True)}


def test_missing_events_leave_and_content_expires(spark, tmp_path):
    feeds = BucketFeeds(spark, tmp_path, 3)
    feeds.options = {"content_ttl_secs": 6}
    feeds.start()
    try:
        known = feeds.write(content("A"))
        feeds.write(event(1, "A"), event(2, "B"))
        feeds.until(lambda: feeds.collector.events >= 2)
        time.sleep(max(0, known + 6.5 - time.time()))
        feeds.write(event(3, "A"))
        feeds.until(lambda: feeds.collector.events >= 3)
    finally:
        feeds.stop()
    assert {r.id: r.content_type for r in feeds.rows().collect() if r.kind == "event"} == {1: "podcast", 2: None, 3: None}


def test_hot_ids_are_found_by_the_job(spark, tmp_path):
    batches = [[(i, "hot" if i % 3 == 0 else f"k{i}") for i in range(a, a + 300)] for a in (0, 300, 600)]
    path = str(tmp_path / "sketches")
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "id long, content_id string").withColumn("kind", F.lit("event"))
        job.note_frequent_ids(df, path, number)
        job.note_frequent_ids(df, path, number)  # a repeated batch counts once
    assert job.frequent_ids(spark, path, 0.1) == ["hot"]
    assert job.frequent_ids(spark, path, 0.5) == []


def test_equals_the_batch_with_deletes_and_slices(spark):
    """The tagged rows of a sliced hot id, put through one machine per slice."""
    arrivals = with_deletes(3, 300)
    from tests.test_asof import frames_with_deletes

    ev, ver = frames_with_deletes(spark, arrivals)
    want = {r.id: (r.content_type, r.drained) for r in enrich_asof(ev, ver).collect()}
    rows = B.tagged_rows(ev, ver, ["hot"], 3, buckets=2).toPandas()
    got = {}
    for _, frame in rows.groupby(["bucket", "slice"]):
        machine = B.BucketLookup(1000, in_order=True)
        handle = Handle()
        machine.init(handle)
        key = (frame.bucket.iloc[0], frame.slice.iloc[0])
        frames = [*machine.handleInputRows(key, iter([frame]), Clock(0)),
                  *machine.handleExpiredTimer(key, Clock(1 << 50), Clock(1 << 50))]
        for out in frames:
            for r in out.itertuples():
                if r.kind == "event":
                    kind = pd.io.json.ujson_loads(r.attributes)["content_type"] if r.attributes else None
                    got[pd.io.json.ujson_loads(r.event)["id"]] = (kind, r.drained)
    assert got == want


@pytest.mark.parametrize("chunk", [1, 5, 10_000])
@pytest.mark.parametrize("size", [1, 7, 50])
@pytest.mark.parametrize("seed", range(3))
def test_a_batch_passes_frame_by_frame(monkeypatch, seed, size, chunk):
    """However a sorted batch is cut into frames and waiting events go to the state, the result is the same."""
    monkeypatch.setattr(B, "_STATE_CHUNK", chunk)
    arrivals = with_deletes(seed)
    turn = sorted(arrivals, key=lambda r: (r[3] is not None, r[3] or "", r[0], KIND_TAGS[r[2]]))
    handle = Handle()
    machine = B.BucketLookup(100_000, None, in_order=True)
    machine.init(handle)
    pulled, out = 0, {}

    def frames():
        nonlocal pulled
        for i in range(0, len(turn), size):
            rows = turn[i:i + size]
            pulled += 1
            yield pd.DataFrame({
                "bucket": 0, "slice": 0, "content_id": [r[3] for r in rows], "tag": [KIND_TAGS[r[2]] for r in rows],
                "at": [r[0] for r in rows], "payload": [r[4] for r in rows]}).astype({"payload": object})

    first = None
    for frame in [*_noted(machine.handleInputRows((0, 0), frames(), Clock(0)), lambda: pulled)]:
        first = first or frame[0]
        for r in frame[1].itertuples():
            if r.kind == "event":
                assert r.event not in out
                out[r.event] = (r.attributes, r.drained)
    assert first == 1  # rows leave before the second frame is read
    for due in sorted(handle.timers):
        for frame in machine.handleExpiredTimer((0, 0), Clock(due), Clock(due)):
            out.update({r.event: (r.attributes, r.drained) for r in frame.itertuples()})
    assert out == simulate(arrivals, 100_000)


def _noted(frames, pulled):
    for frame in frames:
        yield pulled(), frame


def test_frames_out_of_turn_are_refused():
    handle = Handle()
    machine = B.BucketLookup(10)
    machine.init(handle)
    frames = [pd.DataFrame({"content_id": [i], "tag": [B.EVENT], "at": [1], "payload": ["{}"]}) for i in "ba"]
    with pytest.raises(ValueError, match="in_turn"):
        [*machine.handleInputRows((0, 0), iter(frames), Clock(0))]
