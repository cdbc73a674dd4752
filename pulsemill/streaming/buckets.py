"""Stateful enrichment with many content ids in one state value.

The state machine of ``streaming.enrich`` with larger state values: the known items and waiting
ids of a bucket are one value, so a batch costs a few round trips per bucket. On top of that it knows

* deletes: content that is gone is unknown again, later events wait for its return;
* a lifetime of content: an item that was not updated for so long is unknown again;
* an initial state: a catalogue snapshot, or what another checkpoint knew, under another
  layout of buckets, hot ids and slices;
* arrival numbers that both feeds share: rows of a batch are then taken in their order, and
  the result is that of the as-of join.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulsemill.operators.enrich import ATTRIBUTES, finish
from pulsemill.streaming.enrich import (
    DEFAULT_PENDING_TTL_SECS, KIND_EVENT, KIND_FIRST_SEEN, _packed, _slices, _unpacked, _with_seq,
)

CONTENT, DELETED, EVENT, ALIVE = range(4)  # of one arrival number in this order
NEWEST = (1 << 63) - 1  # the position of a change without one
DEFAULT_BUCKETS = 1024

_STATE_CHUNK = 10_000

_ATTRIBUTES = "content_type string, length_seconds long"
_TAGGED = ("bucket", "slice", "content_id", "tag", "at", "payload")
_OUTPUT = "kind string, content_id string, event string, attributes string, found boolean, drained boolean"
_OUT = ["kind", "content_id", "event", "attributes", "found", "drained"]

_ITEM = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("attributes", T.StringType()),  # null while the id waits
    T.StructField("at", T.LongType()),
    T.StructField("known_ms", T.LongType()),
    T.StructField("due_ms", T.LongType()),  # end of the wait
])
_BUCKET = T.StructType([
    T.StructField("items", T.ArrayType(_ITEM)),
    T.StructField("timer_ms", T.LongType()),
])
_WAITING = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("event", T.StringType()),
])


@dataclass
class _Item:
    attributes: str | None = None
    at: int = 0
    known_ms: int | None = None
    due_ms: int | None = None


class _Run:
    """The rows of one id in a batch, as far as they are taken."""

    def __init__(self, content_id: str | None, item: _Item | None):
        self.content_id, self.item = content_id, item
        self.before = item.attributes if item else None
        self.held = bool(item and item.due_ms is not None)
        self.here: list[str] = []  # events of this batch that wait
        self.spilled = False  # others of them wait in the state already
        self.restart = self.changed = False


class BucketLookup(StatefulProcessor):
    """The state machine of the ids of one bucket (or one slice of its hot ids)."""

    def __init__(self, pending_ttl_secs: float, content_ttl_secs: float | None = None, in_order: bool = False):
        if content_ttl_secs is not None and content_ttl_secs < pending_ttl_secs:
            raise ValueError("content must live at least as long as events wait")
        self._wait_ms = int(pending_ttl_secs * 1000)
        self._ttl_ms = None if content_ttl_secs is None else int(content_ttl_secs * 1000)
        self._in_order = in_order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # an untouched bucket holds nothing that is still valid after the lifetime
        self._value = handle.getValueState("items", _BUCKET, self._ttl_ms)
        self._pending = handle.getListState("pending", _WAITING)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Rows like those of a batch; what they would emit is emitted when their ids' next rows come."""
        for _ in self._rows(key, iter([initialState]), timerValues.getCurrentProcessingTimeInMs()):
            pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._rows(key, rows, timerValues.getCurrentProcessingTimeInMs())

    def _rows(self, key, frames: Iterator[pd.DataFrame], now: int) -> Iterator[pd.DataFrame]:
        """A batch's rows, one frame in memory at a time.

        The frames follow each other in the order of ``in_turn``; a frame is sorted again here.
        An id that goes on in the next frame is left open in ``run``.
        """
        part = int(key[1])
        items, timer = self._load(now)
        drained: dict[str, str] = {}  # ids whose events of earlier batches leave
        run, changed = None, False
        for frame in frames:
            if not len(frame):
                continue
            code, ids = pd.factorize(frame["content_id"], use_na_sentinel=False)
            tag, at = frame["tag"].to_numpy(), frame["at"].to_numpy()
            moment = at if self._in_order else np.where(tag < EVENT, -1, 0)
            if run is not None:  # what continues the open id comes first
                first = None if pd.isna(ids[0]) else ids[0]
                if run.content_id is not None and (first is None or first < run.content_id):
                    raise ValueError("frames must follow the order of in_turn")
                code = np.where((pd.isna(ids) if run.content_id is None else ids == run.content_id)[code], -1, code)
            order = np.lexsort((tag, at, moment, code))
            code, tag, at = code[order], tag[order], at[order]
            payload = frame["payload"].to_numpy(object)[order]
            content_ids = frame["content_id"].to_numpy(object)[order]
            begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            out: list[tuple[str | None, list, str | None, bool]] = []  # id, events, attributes, drained
            tokens: list[tuple[str, bool]] = []
            waiting: list[tuple[str | None, str]] = []
            for a, b in zip(begin, [*begin[1:], len(code)], strict=True):
                content_id = None if pd.isna(content_ids[a]) else content_ids[a]
                if run is None or run.content_id != content_id:
                    if run is not None:
                        changed = self._close(run, items, waiting, part, now) or changed
                    run = _Run(content_id, items.get(content_id))
                known = run.item.attributes if run.item else None
                if known is not None and tag[a:b].min() == EVENT:  # events of a known item
                    out.append((content_id, payload[a:b][tag[a:b] == EVENT].tolist(), known, False))
                    continue
                for row in range(a, b):
                    if tag[row] == EVENT:
                        if known is None:
                            run.restart = True
                            run.here.append(payload[row])
                        else:
                            out.append((content_id, [payload[row]], known, False))
                    elif tag[row] == ALIVE:
                        run.restart = run.restart or known is None
                    elif tag[row] == CONTENT:
                        if known is not None and at[row] < run.item.at:
                            continue  # older than what is known
                        if known is None and part == 0 and run.before is None:
                            tokens.append((content_id, run.held or run.restart))
                            run.before = payload[row]
                        known = payload[row]
                        run.item, run.changed = _Item(known, int(at[row]), now), True
                        if run.spilled:
                            yield from self._release({content_id: known})
                        elif run.held:
                            drained[content_id] = known
                        if run.here:
                            out.append((content_id, run.here, known, True))
                        run.here, run.held, run.spilled, run.restart = [], False, False, False
                    elif known is not None and at[row] >= run.item.at:
                        known, run.item, run.changed = None, None, True
            if len(run.here) >= _STATE_CHUNK:  # the open id's events would all be in memory
                waiting += [(run.content_id, event) for event in run.here]
                run.here, run.spilled = [], True
            if drained and any(content_id in drained for content_id, _ in waiting):
                yield from self._release(drained)  # before newer events of their ids wait
                drained = {}
            if waiting:
                self._pending.appendList(waiting)
            yield self._frame(out, tokens)
        waiting = []
        if run is not None:
            changed = self._close(run, items, waiting, part, now) or changed
        if drained:
            yield from self._release(drained)
        if waiting:
            self._pending.appendList(waiting)
        if changed:
            self._store(items, timer)

    def _close(self, run: _Run, items: dict, waiting: list[tuple], part: int, now: int) -> bool:
        """All rows of an id are taken: what the bucket notes of it, and whether that is new."""
        content_id = run.content_id
        if run.item is not None and run.item.attributes is not None:
            items[content_id] = run.item
            return run.changed
        waiting += [(content_id, event) for event in run.here]
        # The first slice of a hot id also keeps time for events of the others.
        if run.restart and (run.here or run.spilled or run.held or part == 0):
            items[content_id] = _Item(due_ms=now + self._wait_ms)
            return True
        if not run.held and content_id in items:
            del items[content_id]
            return True
        return run.changed

    def _release(self, known: dict[str | None, str | None], drained: bool = True) -> Iterator[pd.DataFrame]:
        """Waiting events of these ids leave, in frames of bounded size; the others stay."""
        rest: list[tuple] = []
        out: list[tuple] = []
        for content_id, event in self._pending.get():
            if content_id not in known:
                rest.append((content_id, event))
                continue
            out.append((content_id, [event], known[content_id], drained))
            if len(out) >= _STATE_CHUNK:
                yield self._frame(out, [])
                out = []
        self._keep(rest)
        yield self._frame(out, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        items, _ = self._load(now, keep=True)
        over = {i: None for i, item in items.items() if item.due_ms is not None and item.due_ms <= now}
        if over:
            yield from self._release(over, drained=False)
            items = {i: item for i, item in items.items() if i not in over}
        self._store(items, None)

    def close(self) -> None:
        pass

    def _load(self, now: int, keep: bool = False) -> tuple[dict[str | None, _Item], int | None]:
        state = self._value.get()
        if state is None:
            return {}, None
        items = {row[0]: _Item(*row[1:]) for row in state[0]}
        if self._ttl_ms is not None and not keep:
            items = {i: item for i, item in items.items()
                     if item.known_ms is None or item.known_ms + self._ttl_ms > now}
        return items, state[1]

    def _store(self, items: dict[str | None, _Item], timer: int | None) -> None:
        """Write the bucket; its timer is the earliest end of a wait, or fires before and is set again."""
        due = min((item.due_ms for item in items.values() if item.due_ms is not None), default=None)
        if due is not None and (timer is None or due < timer):
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(due)
            timer = due
        if not items and timer is None:
            self._value.clear()
            return
        self._value.update((
            [(i, item.attributes, item.at, item.known_ms, item.due_ms) for i, item in items.items()], timer))

    def _keep(self, rows: list[tuple]) -> None:
        if rows:
            self._pending.put(rows)
        else:
            self._pending.clear()

    @staticmethod
    def _frame(out: list[tuple], tokens: list[tuple]) -> pd.DataFrame:
        n = [len(events) for _, events, _, _ in out]
        repeated = [np.repeat(np.array([row[k] for row in out], object), n).tolist() for k in (0, 2, 3)]
        ids, attributes, drained = repeated
        return pd.DataFrame({
            "kind": [KIND_EVENT] * len(ids) + [KIND_FIRST_SEEN] * len(tokens),
            "content_id": ids + [i for i, _ in tokens],
            "event": [e for _, events, _, _ in out for e in events] + [None] * len(tokens),
            "attributes": attributes + [None] * len(tokens),
            "found": [a is not None for a in attributes] + [None] * len(tokens),
            "drained": drained + [released for _, released in tokens],
        }, columns=_OUT, dtype=object)


def _bucket(content_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(content_id), F.lit(buckets)).cast("int")


def _position(seq: str = "seq") -> Column:
    return F.coalesce(F.col(seq), F.lit(NEWEST)).cast("long")


def tagged_rows(
    events: DataFrame | None, content: DataFrame | None, hot_ids: Collection[str] = (), hot_slices: int = 16,
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Both feeds, keyed by bucket and slice.

    ``content`` may have ``deleted``. As in ``streaming.enrich`` a hot id's content goes to
    all of its slices and an event to one; the others get a sign of life.
    """
    first = F.lit(0).cast("bigint")
    parts = []
    if events is not None:
        events = _with_seq(events)
        own = F.pmod(F.xxhash64("id", "seq", "event_ts", "user_id", "duration_ms"),
                     _slices(F.col("content_id"), hot_ids, hot_slices))
        rows = events.select("content_id", own.alias("own"), _position().alias("at"), _packed(events).alias("payload"))
        every = F.array("own")
        if hot_ids:
            every = F.when(F.col("content_id").isin(*hot_ids), F.sequence(first, F.lit(hot_slices - 1).cast("bigint"))
                           ).otherwise(every)
        rows = rows.withColumn("slice", F.explode(every))
        here = F.col("slice") == F.col("own")
        parts.append(rows.withColumn("tag", F.when(here, EVENT).otherwise(ALIVE)).withColumn(
            "payload", F.when(here, F.col("payload"))))
    if content is not None:
        content = _with_seq(content)
        gone = F.coalesce("deleted", F.lit(False)) if "deleted" in content.columns else F.lit(False)
        n = _slices(F.col("id"), hot_ids, hot_slices)
        parts.append(content.select(
            F.col("id").alias("content_id"), F.explode(F.sequence(first, n - 1)).alias("slice"),
            F.when(gone, DELETED).otherwise(CONTENT).alias("tag"), _position().alias("at"),
            F.to_json(F.struct(*ATTRIBUTES)).alias("payload")))
    tagged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return tagged.withColumn("bucket", _bucket(F.col("content_id"), buckets)).select(*_TAGGED)


def in_turn(tagged: DataFrame, in_order: bool = False) -> DataFrame:
    """Rows of ``tagged_rows`` as the state machine takes them: id after id, a frame in memory at a time.

    Spark sorts a bucket's rows of a batch, on disk if need be. The partitioning is that of the
    state, so they are not shuffled again.
    """
    moment = F.col("at") if in_order else F.when(F.col("tag") < EVENT, -1).otherwise(0)
    return tagged.repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "content_id", moment, "at", "tag")


def enrich_stream(
    events: DataFrame, content: DataFrame, pending_ttl_secs: float = DEFAULT_PENDING_TTL_SECS,
    hot_ids: Collection[str] = (), hot_slices: int = 16, buckets: int = DEFAULT_BUCKETS,
    content_ttl_secs: float | None = None, in_order: bool = False, initial: DataFrame | None = None,
) -> DataFrame:
    """Enriched events and first-seen tokens (``kind``) of two change streams.

    About a hundred ids a bucket keep a state value small. ``in_order``: both feeds have the
    same arrival numbers, and a batch's rows of an id are taken in that order; else content
    first. Start the stream with ``session.STREAM_SETTINGS``, as ``job.start`` does. ``initial`` is a batch frame of ``tagged_rows``; its events must not be known to it.
    """
    keys = ["bucket", "slice"]
    tagged = in_turn(tagged_rows(events, content, hot_ids, hot_slices, buckets), in_order)
    looked_up = tagged.groupBy(*keys).transformWithStateInPandas(
        BucketLookup(pending_ttl_secs, content_ttl_secs, in_order), _OUTPUT, "Append", "ProcessingTime",
        initial.groupBy(*keys) if initial is not None else None)
    attributes = F.from_json("attributes", _ATTRIBUTES)
    typed = looked_up.withColumn("attributes", attributes).select(
        "kind", "content_id", "event", *[F.col(f"attributes.{c}").alias(c) for c in ATTRIBUTES], "found", "drained")
    return finish(_unpacked(typed, "extras" in events.columns))


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


def known_content(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a checkpoint's state knows: (id, content_type, length_seconds, seq), without ids that wait.

    All slices of a hot id know the same; the newest counts.
    """
    state = _state(spark, checkpoint, "items")
    inner = "value.value.items" if "value" in state.schema["value"].dataType.fieldNames() else "value.items"
    items = state.select(F.explode(inner).alias("i")).where("i.attributes is not null")
    newest = items.groupBy("i.content_id").agg(F.max_by("i.attributes", "i.at").alias("a"), F.max("i.at").alias("at"))
    a = F.from_json("a", _ATTRIBUTES)
    return newest.select(
        F.col("content_id").alias("id"), *[a[c].alias(c) for c in ATTRIBUTES],
        F.when(F.col("at") != NEWEST, F.col("at")).alias("seq"))


def waiting_events(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Events that wait in a checkpoint's state, packed, with their content id."""
    return _state(spark, checkpoint, "pending").select("list_element.content_id", "list_element.event")


def next_flushes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """When the wait of each id ends: (content_id, due)."""
    state = _state(spark, checkpoint, "items")
    inner = "value.value.items" if "value" in state.schema["value"].dataType.fieldNames() else "value.items"
    return state.select(F.explode(inner).alias("i")).where("i.due_ms is not null").groupBy("i.content_id").agg(
        F.timestamp_millis(F.max("i.due_ms")).alias("due"))


def carried_over(
    spark: SparkSession, checkpoint: str, hot_ids: Collection[str] = (), hot_slices: int = 16,
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Initial state of a new checkpoint from another one's, under a new layout.

    Known content goes to all slices that need it. Waiting events are kept by the hash of
    their text and wait anew; those that get no content within it leave flagged as missing.
    """
    content = tagged_rows(None, known_content(spark, checkpoint), hot_ids, hot_slices, buckets)
    waiting = waiting_events(spark, checkpoint)
    own = F.pmod(F.xxhash64("event"), _slices(F.col("content_id"), hot_ids, hot_slices))
    events = waiting.select(
        _bucket(F.col("content_id"), buckets).alias("bucket"), own.alias("slice"), "content_id",
        F.lit(EVENT).alias("tag"), F.lit(NEWEST).alias("at"), F.col("event").alias("payload"))
    return content.unionByName(events)
