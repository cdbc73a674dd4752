"""Delivery of enriched events to a receiver, many events per request.

Documents (one JSON body per request) are built by Spark; a task sends its
documents over one connection and returns a receipt for each.  Delivery is
at-least-once: a task that is run again sends again.
"""

from __future__ import annotations

import http.client
import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from pulsemill.functions.keys import event_json
from pulsemill.sinks.folders import own_folder

DEFAULT_BATCH_SIZE = 500
# Fixed value: how long a request may take.
DEFAULT_TIMEOUT_SECS = 30

RECEIPT = T.StructType([
    T.StructField("sink", T.StringType()),
    T.StructField("batch_no", T.LongType()),
    T.StructField("n_events", T.LongType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_class", T.StringType()),
])

DOCUMENT = T.StructType([
    T.StructField("batch_no", T.LongType()),
    T.StructField("n_events", T.LongType()),
    T.StructField("body", T.StringType()),
])


class Transport(Protocol):
    """What a task needs to reach the receiver."""

    def post(self, body: str) -> int:
        """Send one document, return the status code."""

    def close(self) -> None: ...


class HttpTransport:
    """POST to ``<url>/events`` of a receiver, over one kept connection.

    A connection that the receiver has closed meanwhile is opened once more.
    """

    def __init__(self, url: str, timeout: float = DEFAULT_TIMEOUT_SECS):
        self._url = url.rstrip("/") + "/events"
        self._timeout = timeout
        self._connection = None

    def _open(self):
        parts = urlsplit(self._url)
        kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
        return kind(parts.hostname, parts.port, timeout=self._timeout)

    def post(self, body: str) -> int:
        kept = self._connection is not None
        try:
            return self._request(body)
        except (http.client.RemoteDisconnected, BrokenPipeError, ConnectionResetError):
            if not kept:
                raise
            return self._request(body)

    def _request(self, body: str) -> int:
        if self._connection is None:
            self._connection = self._open()
        try:
            self._connection.request(
                "POST", urlsplit(self._url).path, body.encode("utf-8"), {"Content-Type": "application/json"}
            )
            reply = self._connection.getresponse()
            reply.read()
            return reply.status
        except Exception:
            self.close()
            raise

    def close(self) -> None:
        if self._connection is not None:
            self._connection.close()
            self._connection = None


class DryRun:
    """Sends nothing: accepts documents a receiver would accept."""

    def post(self, body: str) -> int:
        return 200 if isinstance(json.loads(body).get("events"), list) else 422

    def close(self) -> None:
        pass


def document(events: list[str]) -> str:
    """``{"events":[...]}`` from events that are JSON already."""
    return '{"events":[' + ",".join(events) + "]}"


def numbered_batches(
    enriched: DataFrame, seq: str, batch_size: int = DEFAULT_BATCH_SIZE
) -> DataFrame:
    """Documents with fixed numbers: event ``seq`` goes into ``seq // batch_size``.

    ``seq`` is a unique whole number of the row: the arrival number, or the id
    where an event occurs once.  So no document exceeds the batch size and no
    group grows with the data.  One shuffle.  Rows without such a number go
    through ``local_batches``.
    """
    events = enriched.select(
        F.floor(F.col(seq) / batch_size).alias("batch_no"),
        F.struct(F.col(seq).alias("seq"), event_json(enriched).alias("event")).alias("entry"),
    )
    ordered = F.transform(F.array_sort(F.col("entries")), lambda e: e["event"])
    return (
        events.groupBy("batch_no")
        .agg(F.collect_list("entry").alias("entries"))
        .select(
            "batch_no",
            F.size("entries").cast("bigint").alias("n_events"),
            F.concat(F.lit('{"events":['), F.array_join(ordered, ","), F.lit("]}")).alias("body"),
        )
    )


def local_batches(enriched: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Documents of the events a task holds, in their order.  No shuffle.

    Numbers are unique within a task only.
    """
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        number = 0
        for frame in frames:
            waiting.extend(frame["event"])
            full = len(waiting) // batch_size
            for i in range(full):
                chunk = waiting[i * batch_size:(i + 1) * batch_size]
                yield pd.DataFrame(
                    {"batch_no": [number], "n_events": [len(chunk)], "body": [document(chunk)]}
                )
                number += 1
            del waiting[:full * batch_size]
        if waiting:
            yield pd.DataFrame(
                {"batch_no": [number], "n_events": [len(waiting)], "body": [document(waiting)]}
            )

    return enriched.select(event_json(enriched).alias("event")).mapInPandas(pack, DOCUMENT)


def _error_class(error: Exception) -> str:
    if isinstance(error, TimeoutError):
        return "timeout"
    reason = getattr(error, "reason", error)
    if isinstance(reason, TimeoutError):
        return "timeout"
    if isinstance(reason, OSError):
        return "connection"
    return "other"


def _send(
    transport: Transport, body: str, max_attempts: int, pause_secs: float
) -> tuple[int, str, str | None]:
    """(attempts, status, error class); only passing troubles are tried again."""
    failure = "other"
    for attempt in range(1, max_attempts + 1):
        try:
            code = transport.post(body)
        except Exception as error:  # a receiver's trouble must not fail the job
            failure = _error_class(error)
            again = failure != "other"
        else:
            if code == 200:
                return attempt, "ok", None
            failure = "http"
            again = code >= 500 or code == 429
        if not again:
            return attempt, "error", failure
        if attempt < max_attempts:
            time.sleep(pause_secs * 2 ** (attempt - 1))
    return max_attempts, "error", failure


def send(
    documents: DataFrame,
    make_transport: Callable[[], Transport],
    max_attempts: int = 3,
    pause_secs: float = 0.2,
    sink: str = "http",
) -> DataFrame:
    """Send documents and return one receipt per document.

    Sending happens when the receipts are computed, so write them once (see
    ``deliver``) and count from what was written.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transport = make_transport()
        try:
            for frame in frames:
                results = [_send(transport, b, max_attempts, pause_secs) for b in frame["body"]]
                yield pd.DataFrame({
                    "sink": sink,
                    "batch_no": frame["batch_no"],
                    "n_events": frame["n_events"],
                    "attempts": [r[0] for r in results],
                    "status": [r[1] for r in results],
                    "error_class": [r[2] for r in results],
                }, columns=RECEIPT.fieldNames())
        finally:
            transport.close()

    return documents.mapInPandas(run, RECEIPT)


def delivered(
    enriched: DataFrame,
    make_transport: Callable[[], Transport],
    batch_size: int = DEFAULT_BATCH_SIZE,
    **options,
) -> DataFrame:
    """Events to receipts in one step: ``df.transform(delivered, make_transport)``."""
    return send(local_batches(enriched, batch_size), make_transport, **options)


def deliver(
    enriched: DataFrame,
    make_transport: Callable[[], Transport],
    receipts_path: str,
    batch_id: int = 0,
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_attempts: int = 3,
    pause_secs: float = 0.2,
) -> None:
    """Send every event and keep the receipts of the batch."""
    receipts = enriched.transform(
        delivered, make_transport, batch_size, max_attempts=max_attempts, pause_secs=pause_secs
    )
    receipts.write.mode("overwrite").parquet(own_folder(enriched.sparkSession, receipts_path, batch_id))


def events_of(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Receiver's view: the events inside documents, typed."""
    parsed = F.from_json("body", T.StructType([T.StructField("events", T.ArrayType(schema))]))
    return documents.select("batch_no", F.explode(parsed["events"]).alias("event")).select(
        "batch_no", "event.*"
    )

