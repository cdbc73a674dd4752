"""Delivery as a data source: what was sent counts when the batch commits.

``register`` names a sink for ``df.write.format(name)`` and ``df.writeStream.format(name)``.
A task packs its events into documents and sends them; its commit message holds counts of
the outcomes only, so the driver gets a few rows per task. The receipts of a batch become
one file when all its tasks have ended well. Sending is at-least-once: a task or batch that
is run again sends again, but only the try that commits leaves receipts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)

from pulsemill.functions.keys import event_json
from pulsemill.sinks.delivery import DEFAULT_BATCH_SIZE, Transport, _send, document

OUTCOME = pa.schema([
    ("sink", pa.string()), ("status", pa.string()), ("error_class", pa.string()),
    ("n_requests", pa.int64()), ("n_events", pa.int64()), ("attempts", pa.int64()),
])
OUTCOME_DDL = "sink string, status string, error_class string, n_requests long, n_events long, attempts long"
# Troubles that may pass: a task that still meets one after its attempts fails, and is run again.
PASSING = ("connection", "timeout", "unavailable")


class DeliveryError(RuntimeError):
    """The receiver could not be reached; what the task sent does not count."""


@dataclass
class Outcomes(WriterCommitMessage):
    """(status, error class) -> (requests, events, attempts) of one task."""

    counts: dict[tuple[str, str | None], tuple[int, int, int]]


@dataclass
class Delivery:
    """Settings that travel to the tasks."""

    name: str
    make_transport: Callable[[], Transport]
    receipts_path: str
    batch_size: int
    max_attempts: int
    pause_secs: float

    def send_all(self, batches: Iterator[pa.RecordBatch]) -> Outcomes:
        found: dict[tuple[str, str | None], Counter] = {}
        transport = self.make_transport()
        try:
            for events in self._documents(batches):
                tries, status, failure = _send(transport, document(events), self.max_attempts, self.pause_secs)
                # a receiver that answers 5xx or 429 to the last attempt is out of order, too
                if failure in PASSING or (failure == "http" and tries == self.max_attempts > 1):
                    raise DeliveryError(f"{self.name}: {failure} after {tries} attempts")
                found.setdefault((status, failure), Counter()).update(
                    n_requests=1, n_events=len(events), attempts=tries)
        finally:
            transport.close()
        return Outcomes({k: (c["n_requests"], c["n_events"], c["attempts"]) for k, c in found.items()})

    def _documents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        """Events in the task's order, at most one document of them in memory beside the batch."""
        waiting: list[str] = []
        for batch in batches:
            for event in batch.column(0).to_pylist():
                waiting.append(event)
                if len(waiting) == self.batch_size:
                    yield waiting
                    waiting = []
        if waiting:
            yield waiting

    def keep(self, messages: list[WriterCommitMessage | None], batch_id: int) -> None:
        """Write the batch's receipts, in place of those of an earlier commit of it."""
        totals: dict[tuple[str, str | None], Counter] = {}
        for message in messages:
            for key, (requests, events, attempts) in (message.counts if message else {}).items():
                totals.setdefault(key, Counter()).update(n_requests=requests, n_events=events, attempts=attempts)
        rows = [{"sink": self.name, "status": status, "error_class": failure, **totals[status, failure]}
                for status, failure in sorted(totals, key=str)]
        files, folder = pafs.FileSystem.from_uri(self.receipts_path)
        files.create_dir(folder, recursive=True)
        # readers pass over names that begin with an underscore, so a half-written file is never seen
        part, target = f"{folder}/_batch-{batch_id}", f"{folder}/batch-{batch_id}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, OUTCOME), part, filesystem=files)
        if files.get_file_info(target).type != pafs.FileType.NotFound:
            files.delete_file(target)  # not every file system moves onto a file
        files.move(part, target)


class _Batch(DataSourceArrowWriter):
    def __init__(self, delivery: Delivery, batch_id: int):
        self.delivery, self.batch_id = delivery, batch_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.delivery.send_all(iterator)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.delivery.keep(messages, self.batch_id)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing was kept."""


class _Stream(DataSourceStreamArrowWriter):
    def __init__(self, delivery: Delivery):
        self.delivery = delivery

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.delivery.send_all(iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.delivery.keep(messages, batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Nothing was kept."""


def register(
    spark: SparkSession,
    name: str,
    make_transport: Callable[[], Transport],
    receipts_path: str,
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_attempts: int = 3,
    pause_secs: float = 0.2,
) -> str:
    """Make ``name`` a sink for frames of one text column of JSON events (see ``events``).

    ``receipts_path`` is a folder all drivers of the job can write (a path or a URI that
    Arrow knows) and belongs to one streaming checkpoint: batch numbers begin anew with
    each. A batch write keeps its receipts under the option ``batch_id``, 0 by default. A
    refusal (4xx) is an outcome and is counted; a receiver that can't be reached, or is out
    of order, fails the task, and with it the batch if repeated tasks fail as well.
    """
    settings = Delivery(name, make_transport, receipts_path, batch_size, max_attempts, pause_secs)

    class Receiver(DataSource):
        @classmethod
        def name(cls) -> str:
            return settings.name

        def schema(self) -> T.StructType:
            return T.StructType([T.StructField("event", T.StringType())])

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
            return _Batch(settings, int(self.options.get("batch_id", 0)))

        def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
            return _Stream(settings)

    spark.dataSource.register(Receiver)
    return name


def events(enriched: DataFrame) -> DataFrame:
    """The text column the sink takes."""
    return enriched.select(event_json(enriched).alias("event"))


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes of all committed batches."""
    return spark.read.schema(OUTCOME_DDL).parquet(path)
