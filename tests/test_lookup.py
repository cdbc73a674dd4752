"""The state machine of ``streaming.enrich`` alone: frames, shelves and timers against a plain model."""

import json
import random
from collections import Counter

import pandas as pd
import pytest

from pulsemill.streaming import enrich as E
from tests.test_asof import frames as feeds
from tests.test_asof import recorded

WAIT = 10


class Handle:
    """Map states and timers in memory, with a count of the calls."""

    def __init__(self):
        self.maps, self.timers, self.calls = {}, set(), 0

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, Map(self, len(key), len(value)))

    def registerTimer(self, at):
        self.timers.add(at)


class Map:
    def __init__(self, handle, key, value):
        self.handle, self.sizes, self.rows = handle, (key, value), {}

    def exists(self):
        return bool(self.rows)

    def containsKey(self, key):
        self.handle.calls += 1
        return key in self.rows

    def getValue(self, key):
        self.handle.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        assert (len(key), len(value)) == self.sizes
        self.handle.calls += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.handle.calls += 1
        del self.rows[key]


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


def lookup():
    machine, handle = E.ContentLookup(WAIT / 1000), Handle()
    machine.init(handle)
    return machine, handle


def shelf(content_id):
    return 0 if content_id is None else sum(map(ord, content_id)) % 3


def version(kind, length=None, seq=None):
    return json.dumps({k: v for k, v in (("content_type", kind), ("length_seconds", length), ("seq", seq)) if v is not None})


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (shelf(r[0]), r[0] is not None, r[0] or "", r[1] != E.CONTENT))


def frames(rows, size):
    """Rows of (id, tag, payload) as Spark hands them over."""
    for i in range(0, len(rows), size):
        piece = rows[i:i + size]
        yield pd.DataFrame({
            "group": 0, "slice": 0, "shelf": [shelf(r[0]) for r in piece], "content_id": [r[0] for r in piece],
            "tag": [r[1] for r in piece], "payload": [r[2] for r in piece]}).astype(
                {"content_id": object, "payload": object})


def plain(out):
    found = []
    for frame in out:
        assert list(frame.columns) == E.OUTPUT.fieldNames() and len(frame)
        found += [tuple(None if v is None or v != v else v for v in row) for row in frame.itertuples(index=False)]
    return Counter(found)


class Model:
    """One id at a time, content of a batch first."""

    def __init__(self, part=0):
        self.part, self.known, self.waiting, self.due = part, {}, {}, {}

    def batch(self, now, rows):
        out = []
        for i in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == i]
            for text in [r[2] for r in mine if r[1] == E.CONTENT]:
                new = json.loads(text)
                new = (new.get("content_type"), new.get("length_seconds"), new.get("seq"))
                old = self.known.get(i)
                if old is None and self.part == 0:
                    out.append((E.KIND_FIRST_SEEN, i, None, None, None, None, i in self.due))
                if old is None or new[2] is None or old[2] is None or new[2] >= old[2]:
                    self.known[i] = new
            if i in self.known:
                self.due.pop(i, None)
                out += [(E.KIND_EVENT, i, e, *self.known[i][:2], True, True) for e in self.waiting.pop(i, [])]
                out += [(E.KIND_EVENT, i, r[2], *self.known[i][:2], True, False) for r in mine if r[1] == E.EVENT]
            else:
                new = [r[2] for r in mine if r[1] == E.EVENT]
                self.waiting[i] = self.waiting.get(i, []) + new
                if new or i in self.due or self.part == 0:
                    self.due[i] = now + WAIT
        return Counter(out)

    def over(self, now):
        out = []
        for i in [i for i, due in self.due.items() if due <= now]:
            del self.due[i]
            out += [(E.KIND_EVENT, i, e, None, None, False, False) for e in self.waiting.pop(i, [])]
        return Counter(out)


def script(seed, batches=40):
    """Batches of events, versions and signs of life, some of them an instant's twin."""
    rng = random.Random(seed)
    ids, now, number = [None, "é", *"abcdefgh"], 0, 0
    for _ in range(batches):
        rows = []
        for _ in range(rng.randrange(25)):
            number += 1
            i = rng.choice(ids)
            if i is not None and rng.random() < 0.08:
                rows.append((i, E.CONTENT, version(f"v{number}", rng.choice([None, 2**60 + 1]), rng.choice([None, number, 5]))))
            elif rng.random() < 0.2:
                rows.append((i, E.ALIVE, None))
            else:
                rows.append((i, E.EVENT, f"e{number}"))
        yield now, sorted_rows(rows)
        now += rng.choice([0, 1, 3, 12])


@pytest.mark.parametrize("part", [0, 1])
@pytest.mark.parametrize("size, chunk", [(1, 1), (3, 2), (7, 1_000), (1_000, 3)])
@pytest.mark.parametrize("seed", range(3))
def test_equals_the_model(monkeypatch, seed, size, chunk, part):
    """However batches are cut into frames and chunks."""
    monkeypatch.setattr(E, "_STATE_CHUNK", chunk)
    monkeypatch.setattr(E, "_FRAME_ROWS", chunk)
    machine, handle = lookup()
    model = Model(part)
    seen = Counter()
    for now, rows in script(seed):
        if rows:
            got = plain(machine.handleInputRows((0, part), frames(rows, size), Clock(now)))
            assert got == model.batch(now, rows)
            seen += got
        over = Counter()
        for due in sorted(t for t in handle.timers if t <= now):
            over += plain(machine.handleExpiredTimer((0, part), Clock(now), Clock(due)))
            handle.timers.remove(due)
        assert over == model.over(now)
        seen += over
    assert {r[5:] for r in seen if r[0] == E.KIND_EVENT} == {(True, True), (True, False), (False, False)}
    waiting = {(i, e) for i, events in model.waiting.items() for e in events}
    assert {(k[0], e) for k, v in handle.maps["pending"].rows.items() for e in v[0]} == waiting


def test_ids_out_of_order_are_read_again():
    """An id, or its shelf, that comes back later in a batch finds what the batch wrote before."""
    machine, _ = lookup()
    rows = [("a", E.CONTENT, version("x", 1, 1)), ("b", E.EVENT, "1"), ("d", E.EVENT, "2"), ("a", E.EVENT, "3"),
            ("c", E.EVENT, "4"), ("b", E.CONTENT, version("y")), ("a", E.EVENT, "5")]
    got = plain(machine.handleInputRows((0, 0), frames(rows, 2), Clock(0)))
    assert {r[2]: (r[3], r[6]) for r in got if r[2]} == {"1": ("y", True), "3": ("x", False), "5": ("x", False)}


def test_rows_of_a_hot_id_leave_in_frames():
    """Before, all that left of an id in a batch was in memory at once."""
    machine, _ = lookup()
    rows = [("a", E.CONTENT, version("x")), *[("a", E.EVENT, str(i)) for i in range(100_000)]]
    read = 0

    def counted():
        nonlocal read
        for frame in frames(rows, 10_000):
            read += 1
            yield frame

    sizes, ahead = [], []
    for frame in machine.handleInputRows((0, 0), counted(), Clock(0)):
        sizes.append(len(frame))
        ahead.append(read)
    assert sum(sizes) == 100_001 and max(sizes) <= 20_000
    assert ahead[0] <= 2 and len(sizes) >= 6


def test_waiting_events_are_bounded_by_length_and_leave_in_frames():
    machine, handle = lookup()
    rows = [("a", E.EVENT, f"{i}-" + "x" * 100_000) for i in range(60)]
    assert not plain(machine.handleInputRows((0, 0), frames(rows, 20), Clock(0)))
    chunks = handle.maps["pending"].rows.values()
    assert max(sum(map(len, c[0])) for c in chunks) <= E._STATE_CHARS + 100_010 and len(chunks) >= 6
    got = plain(machine.handleInputRows((0, 0), frames([("a", E.CONTENT, version("x"))], 9), Clock(1)))
    assert sum(r[0] == E.KIND_EVENT and r[5:] == (True, True) for r in got) == 60
    assert not handle.maps["pending"].rows


def test_state_calls_follow_the_shelves():
    """Before, each id of a batch cost calls of its own."""
    machine, handle = lookup()
    rows = sorted_rows([(f"c-{i}", E.CONTENT, version("x", i, 1)) for i in range(3_000)])
    assert len(plain(machine.handleInputRows((0, 0), frames(rows, 500), Clock(0)))) == 3_000
    assert handle.calls <= 3
    events = sorted_rows([(f"c-{i}", E.EVENT, "e") for i in range(3_000)])
    assert len(plain(machine.handleInputRows((0, 0), frames(events, 500), Clock(1)))) == 3_000
    assert handle.calls <= 6  # nothing new is known: read only


def test_slices_of_a_hot_id_equal_one_machine(spark):
    """Rows of a group come in order; a machine per group and slice gives what one per group gives."""
    ev, ver = feeds(spark, recorded(1, 400))
    results, slices = [], []
    for hot in ((), ("hot",)):
        rows = E.in_groups(E.tagged_streams(ev, ver, hot, 3)).toPandas()
        got, keys = Counter(), rows.groupby(["group", "slice"], sort=False)
        for key, mine in keys:
            assert mine.shelf.is_monotonic_increasing and mine.groupby("shelf").content_id.apply(
                lambda ids: ids.dropna().is_monotonic_increasing).all()
            machine, handle = lookup()
            pieces = (mine.iloc[i:i + 5] for i in range(0, len(mine), 5))
            got += plain(machine.handleInputRows(key, pieces, Clock(0)))
            for due in sorted(handle.timers):
                got += plain(machine.handleExpiredTimer(key, Clock(due), Clock(due)))
        results.append(got)
        slices.append(len(keys))
    assert results[0] == results[1] and sum(r[0] == E.KIND_EVENT for r in results[0].elements()) == ev.count()
    assert slices[1] == slices[0] + 2


def test_a_slice_with_signs_of_life_emits_frame_by_frame():
    """Before, a slice held all its events of a batch; signs of life between them change nothing."""
    machine, _ = lookup()
    rows = [("a", E.CONTENT, version("x"))]
    rows += [("a", E.ALIVE, None) if i % 4 else ("a", E.EVENT, str(i)) for i in range(100_000)]
    sizes = [len(f) for f in machine.handleInputRows((0, 1), frames(rows, 10_000), Clock(0))]
    assert sum(sizes) == 25_000 and max(sizes) <= 15_000 and len(sizes) >= 2
