"""Stateful enrichment of two change streams.

State per content id: the newest catalogue attributes, and the events that wait
for a first version.  Content replaces state and releases waiting events; an
event is emitted at once if its content is known, else it waits.  Each waiting
event restarts the wait of its id; when it ends, the waiting events leave
flagged as missing.  Content never leaves the state.

Ids come in groups: the rows of a group pass through Python as frames, so a batch
pays Spark's calls per key once a group, and what an id emits need not fit in memory.
Within a group, ids whose hashes agree share a state value, a shelf: few while the
catalogue is small, about a hundred in one of seven million.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulsemill.functions.envelopes import evaluated_once
from pulsemill.operators.enrich import finish
from pulsemill.schemas import ENGAGEMENT

EVENT, CONTENT, ALIVE = "main", "content", "alive"
DEFAULT_PENDING_TTL_SECS = 10
KEYLESS_SLICES = 64
GROUPS = 1024  # of ids, and shelves in a group: fixed by a checkpoint's first start
SHELVES = 64
_STATE_CHUNK = 1_000  # events or ids in one state value
_STATE_CHARS = 1_000_000
_FRAME_ROWS = 10_000

_EVENT_FIELDS = [f for f in ENGAGEMENT.fields if f.name != "content_id"]

# An event passes the state machine packed as one JSON text: Python then
# converts few columns per row.  Instants travel as whole microseconds.
_PACKED = T.StructType(
    [
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in _EVENT_FIELDS
    ]
    + [T.StructField("seq", T.LongType())]
)

# ``due_ms`` is set while events wait for a first version, and then tells when the wait
# ends; without it the item is the known content.
_ITEM = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("length_seconds", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("due_ms", T.LongType()),
    T.StructField("chunks", T.LongType()),  # of waiting events
])
_SHELF = T.StructType([T.StructField("shelf", T.IntegerType())])
_ITEMS = T.StructType([T.StructField("items", T.ArrayType(_ITEM))])
_CHUNK = T.StructType([T.StructField("content_id", T.StringType()), T.StructField("number", T.LongType())])
_EVENTS = T.StructType([T.StructField("events", T.ArrayType(T.StringType()))])
_MOMENT = T.StructType([T.StructField("due_ms", T.LongType()), T.StructField("number", T.LongType())])
_IDS = T.StructType([T.StructField("ids", T.ArrayType(T.StructType([_SHELF["shelf"], _ITEM["content_id"]])))])

_TAGGED = ("content_id", "slice", "tag", "content_type", "length_seconds", "seq", "event")

# The operator's output; ``kind`` tells events from first-seen tokens.
OUTPUT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("length_seconds", T.LongType()),
    T.StructField("found", T.BooleanType()),
    # Event: it had to wait for its content.  Token: its content released events.
    T.StructField("drained", T.BooleanType()),
])
KIND_EVENT, KIND_FIRST_SEEN = "event", "first_seen"


class _Run:
    """What a batch has brought for one id so far."""

    def __init__(self, content_id: str | None, state: tuple | None):
        self.content_id = content_id
        self.due, self.chunks = (state[3], state[4]) if state is not None else (None, 0)
        self.known = self.before = tuple(state[:3]) if state is not None and self.due is None else None
        self.arrived: list[str] = []  # events of this batch that wait
        self.chars = 0  # their length
        self.restart = self.announced = False


@dataclass
class _Shelf:
    number: int
    items: dict[str | None, tuple]  # by id: the other fields of ``_ITEM``
    changed: bool = False


class _Output:
    """Rows to emit, in frames of bounded size."""

    def __init__(self):
        self._parts: list[tuple] = []
        self._rows = 0

    def events(self, content_id: str | None, events: list[str], known: tuple | None, drained: bool) -> None:
        content_type, length = known[:2] if known is not None else (None, None)
        self._parts.append((KIND_EVENT, content_id, events, content_type, length, known is not None, drained))
        self._rows += len(events)

    def token(self, content_id: str, released: bool) -> None:
        self._parts.append((KIND_FIRST_SEEN, content_id, [None], None, None, None, released))
        self._rows += 1

    def frames(self, at_least: int = _FRAME_ROWS) -> Iterator[pd.DataFrame]:
        """One frame if enough rows have come together."""
        if self._rows < at_least:
            return
        n = [len(part[2]) for part in self._parts]
        columns = {
            name: np.repeat(np.array([part[k] for part in self._parts], object), n)
            for k, name in enumerate(OUTPUT.fieldNames()) if name != "event"
        }
        columns["event"] = np.array([e for part in self._parts for e in part[2]], object)
        self._parts, self._rows = [], 0
        yield pd.DataFrame(columns, columns=OUTPUT.fieldNames())


class ContentLookup(StatefulProcessor):
    """The state machine of the ids of one group (or one slice of its hot ids).

    Each state call is a round trip to the JVM: a read and a write per shelf and batch, and
    one per chunk of waiting events.  A group has one timer per batch that made ids wait.
    """

    def __init__(self, pending_ttl_secs: float):
        self._wait_ms = int(pending_ttl_secs * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._content = handle.getMapState("content", _SHELF, _ITEMS)
        self._pending = handle.getMapState("pending", _CHUNK, _EVENTS)
        self._waits = handle.getMapState("waits", _MOMENT, _IDS)  # ids by the end of their wait

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """A batch's rows, a frame in memory at a time; an id may go on in the next frame."""
        part = int(key[1])
        until = timerValues.getCurrentProcessingTimeInMs() + self._wait_ms
        nothing_known = not self._content.exists()
        highest = -1  # shelves come in order: none beyond this was written in this batch
        shelf: _Shelf | None = None
        run: _Run | None = None
        waiting: list[tuple] = []
        out = _Output()
        for frame in rows:
            for number, content_id, versions, events, alive in _runs(frame):
                if run is None or run.content_id != content_id:
                    if run is not None:
                        yield from self._close(run, shelf, part, until, waiting, out)
                    if shelf is None or shelf.number != number:
                        if shelf is not None:
                            self._store(shelf)
                        shelf = _Shelf(number, {}) if nothing_known and number > highest else self._load(number)
                        highest = max(highest, number)
                    run = _Run(content_id, shelf.items.get(content_id))
                for version in versions:
                    read = json.loads(version)
                    seq = read.get("seq")
                    if run.known is None or seq is None or run.known[2] is None or seq >= run.known[2]:
                        run.known = (read.get("content_type"), read.get("length_seconds"), seq)
                if run.known is None:
                    run.restart = run.restart or alive or bool(events)
                    run.arrived += events
                    run.chars += sum(map(len, events))
                    if len(run.arrived) >= _STATE_CHUNK or run.chars >= _STATE_CHARS:
                        self._put_off(run)
                elif events:
                    yield from self._release(run, part, out)
                    out.events(content_id, events, run.known, False)
            yield from out.frames()
        if run is not None:
            yield from self._close(run, shelf, part, until, waiting, out)
            self._store(shelf)
        self._wait(waiting, until)
        yield from out.frames(1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = expiredTimerInfo.getExpiryTimeInMs()
        out = _Output()
        shelf: _Shelf | None = None
        number = 0
        while (ids := self._waits.getValue((over, number))) is not None:
            for at, content_id in ids[0]:
                if shelf is None or shelf.number != at:
                    if shelf is not None:
                        self._store(shelf)
                    shelf = self._load(at)
                state = shelf.items.get(content_id)
                if state is not None and state[3] == over:  # else known by now, or its wait was restarted
                    yield from self._drain(_Run(content_id, state), None, out)
                    shelf.items.pop(content_id)
                    shelf.changed = True
            self._waits.removeKey((over, number))
            number += 1
        if shelf is not None:
            self._store(shelf)
        yield from out.frames(1)

    def close(self) -> None:
        pass

    def _load(self, number: int) -> _Shelf:
        state = self._content.getValue((number,))
        return _Shelf(number, {item[0]: tuple(item[1:]) for item in state[0]} if state is not None else {})

    def _store(self, shelf: _Shelf) -> None:
        if not shelf.changed:
            return
        if shelf.items:
            self._content.updateValue((shelf.number,), ([(i, *state) for i, state in shelf.items.items()],))
        else:
            self._content.removeKey((shelf.number,))
        shelf.changed = False

    def _close(
        self, run: _Run, shelf: _Shelf, part: int, until: int, waiting: list[tuple], out: _Output
    ) -> Iterator[pd.DataFrame]:
        """All rows of an id are taken: what the state keeps of it."""
        if run.known is not None:
            yield from self._release(run, part, out)
            if run.known != run.before:
                shelf.items[run.content_id] = (*run.known, None, 0)
                shelf.changed = True
            return
        self._put_off(run)
        # The first slice of a hot id also keeps time for events of the others.
        if run.restart and (run.chunks or run.due is not None or part == 0):
            shelf.items[run.content_id] = (None, None, None, until, run.chunks)
            shelf.changed = True
            waiting.append((shelf.number, run.content_id))

    def _put_off(self, run: _Run) -> None:
        """The id's events of this batch wait in the state."""
        for chunk in _chunks(run.arrived):
            self._pending.updateValue((run.content_id, run.chunks), (chunk,))
            run.chunks += 1
        run.arrived, run.chars = [], 0

    def _release(self, run: _Run, part: int, out: _Output) -> Iterator[pd.DataFrame]:
        """Events that waited for a first version leave when it is known."""
        if run.before is not None or run.announced:
            return
        run.announced = True
        if part == 0:
            out.token(run.content_id, run.due is not None or run.restart)
        yield from self._drain(run, run.known, out)

    def _drain(self, run: _Run, known: tuple | None, out: _Output) -> Iterator[pd.DataFrame]:
        for number in range(run.chunks):
            chunk = (run.content_id, number)
            out.events(run.content_id, list(self._pending.getValue(chunk)[0]), known, known is not None)
            self._pending.removeKey(chunk)
            yield from out.frames()
        if run.arrived:
            out.events(run.content_id, run.arrived, known, True)
            run.arrived, run.chars = [], 0

    def _wait(self, ids: list[tuple], until: int) -> None:
        """Note whose wait ends when; a wait that is moved leaves its earlier note behind."""
        if not ids:
            return
        number = 0
        while self._waits.containsKey((until, number)):  # of a batch of the same instant
            number += 1
        for begin in range(0, len(ids), _STATE_CHUNK):
            self._waits.updateValue((until, number), (ids[begin:begin + _STATE_CHUNK],))
            number += 1
        self._handle.registerTimer(until)


def _chunks(events: list[str]) -> Iterator[list[str]]:
    chunk, chars = [], 0
    for event in events:
        chunk.append(event)
        chars += len(event)
        if len(chunk) >= _STATE_CHUNK or chars >= _STATE_CHARS:
            yield chunk
            chunk, chars = [], 0
    if chunk:
        yield chunk


def _runs(frame: pd.DataFrame) -> Iterator[tuple[int, str | None, list[str], list[str], bool]]:
    """Of each id: its shelf, its versions, its events, and whether there are signs of life."""
    if not len(frame):
        return
    ids, tags = frame["content_id"].to_numpy(object), frame["tag"].to_numpy(object)
    shelves, payload = frame["shelf"].tolist(), frame["payload"].tolist()
    ids = np.where(pd.isna(ids), None, ids)
    version, event = tags == CONTENT, tags == EVENT
    begin = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    bounds = zip(
        begin.tolist(), [*begin[1:].tolist(), len(ids)],
        np.add.reduceat(version, begin, dtype=int).tolist(), np.add.reduceat(event, begin, dtype=int).tolist(),
    )
    for a, b, versions, events in bounds:
        if events == b - a:
            yield shelves[a], ids[a], [], payload[a:b], False
            continue
        yield (
            shelves[a], ids[a], [payload[i] for i in range(a, b) if version[i]] if versions else [],
            [payload[i] for i in range(a, b) if event[i]] if events else [], versions + events < b - a,
        )


def _packed(events: DataFrame) -> Column:
    fields = [
        F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in _EVENT_FIELDS
    ]
    fields += [F.col("seq"), *[F.col(c) for c in ("extras",) if c in events.columns]]
    return F.to_json(F.struct(*fields))


def _unpacked(output: DataFrame, extras: bool) -> DataFrame:
    """Typed event columns again, parsed once per row."""
    schema = T.StructType(list(_PACKED.fields))
    if extras:
        schema = schema.add("extras", T.MapType(T.StringType(), T.VariantType()))
    output = output.withColumn("row", F.from_json("event", schema))
    columns = {f.name: F.col(f"row.{f.name}") for f in schema.fields}
    for f in _EVENT_FIELDS:
        if isinstance(f.dataType, T.TimestampType):
            columns[f.name] = F.timestamp_micros(columns[f.name])
    kept = ["kind", "content_id", "content_type", "length_seconds", "found", "drained"]
    return evaluated_once(output, kept, **columns)


def _slices(content_id: Column, hot_ids: Collection[str], hot_slices: int) -> Column:
    """Number of slices of an id: one, ``hot_slices`` for the named hot ids.

    Events without id can only end as missing, so theirs need no common wait.
    """
    n = F.when(content_id.isNull(), F.lit(KEYLESS_SLICES))
    if hot_ids:
        n = n.when(content_id.isin(*hot_ids), F.lit(hot_slices))
    return n.otherwise(F.lit(1)).cast("bigint")


def tagged_streams(
    events: DataFrame,
    content: DataFrame,
    hot_ids: Collection[str] = (),
    hot_slices: int = 16,
) -> DataFrame:
    """Union of both feeds, keyed by content id and slice.

    An id named hot is spread over slices: its content goes to every slice, an
    event to one of them.  The others get an ``alive`` row, so that the wait of
    all slices restarts together as if there were one.
    """
    first = F.lit(0).cast("bigint")
    n = _slices(F.col("content_id"), hot_ids, hot_slices)
    events = _with_seq(events)
    own = F.pmod(F.xxhash64("id", "seq", "event_ts", "user_id", "duration_ms"), n)
    fields = events.select("content_id", own.alias("own"), "seq", _packed(events).alias("event"))
    if hot_ids:
        every = F.sequence(first, F.lit(hot_slices - 1).cast("bigint"))
        hot = F.col("content_id").isin(*hot_ids)
        fields = fields.withColumn("slice", F.explode(F.when(hot, every).otherwise(F.array("own"))))
    else:
        fields = fields.withColumn("slice", F.col("own"))
    here = F.col("slice") == F.col("own")
    rows = fields.select(
        "content_id", "slice", F.when(here, EVENT).otherwise(ALIVE).alias("tag"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("bigint").alias("length_seconds"),
        "seq", F.when(here, F.col("event")).alias("event"),
    )
    n = _slices(F.col("id"), hot_ids, hot_slices)
    versions = _with_seq(content).select(
        F.col("id").alias("content_id"), F.explode(F.sequence(first, n - 1)).alias("slice"),
        F.lit(CONTENT).alias("tag"), "content_type", "length_seconds", "seq",
        F.lit(None).cast("string").alias("event"),
    )
    return rows.unionByName(versions).select(*_TAGGED)


def _with_seq(feed: DataFrame) -> DataFrame:
    return feed if "seq" in feed.columns else feed.withColumn("seq", F.lit(None).cast("bigint"))


def in_groups(tagged: DataFrame) -> DataFrame:
    """Rows of ``tagged_streams`` as the state machine takes them: shelf after shelf, id after id, content first.

    Spark sorts a group's rows of a batch, on disk if need be. The partitioning is that of the
    state, so they are not shuffled again.
    """
    version = F.to_json(F.struct("content_type", "length_seconds", "seq"))
    place = F.pmod(F.xxhash64("content_id"), F.lit(GROUPS * SHELVES)).cast("int")
    return tagged.select(
        (place % GROUPS).alias("group"), "slice", F.floor(place / GROUPS).cast("int").alias("shelf"), "content_id",
        "tag", F.when(F.col("tag") == CONTENT, version).otherwise(F.col("event")).alias("payload"),
    ).repartition("group", "slice").sortWithinPartitions(
        "group", "slice", "shelf", "content_id", F.col("tag") != CONTENT)


def enrich_stream(
    events: DataFrame,
    content: DataFrame,
    pending_ttl_secs: float = DEFAULT_PENDING_TTL_SECS,
    hot_ids: Collection[str] = (),
    hot_slices: int = 16,
) -> DataFrame:
    """Enriched events and first-seen tokens (``kind``) of two change streams.

    Measures are computed after the state machine, in the JVM.  An id's rows of a batch come
    sorted, content first, so that events of content of the same batch need not pass through
    the waiting list.  Start the stream with ``session.STREAM_SETTINGS``, as ``job.start`` does.
    """
    rows = in_groups(tagged_streams(events, content, hot_ids, hot_slices))
    looked_up = rows.groupBy("group", "slice").transformWithStateInPandas(
        ContentLookup(pending_ttl_secs), OUTPUT, "Append", "ProcessingTime"
    )
    return finish(_unpacked(looked_up, "extras" in events.columns))


def enriched_events(output: DataFrame) -> DataFrame:
    return output.where(F.col("kind") == KIND_EVENT).drop("kind")


def first_seen(output: DataFrame) -> DataFrame:
    """One token per newly known content id."""
    return output.where(F.col("kind") == KIND_FIRST_SEEN).select("content_id")
