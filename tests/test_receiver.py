"""The delivery data source: receipts belong to committed batches only."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pulsemill.sinks import receiver


class Flagged:
    """Accepts everything, but event 7 only once the flag's file is there."""

    def __init__(self, flag, code):
        self.flag, self.code = flag, code

    def post(self, body):
        ids = [e["id"] for e in json.loads(body)["events"]]
        return self.code if 7 in ids and not os.path.exists(self.flag) else 200

    def close(self):
        pass


def sink(spark, tmp_path, name, code=503):
    flag, path = str(tmp_path / "flag"), str(tmp_path / "receipts")
    receiver.register(spark, name, lambda: Flagged(flag, code), path, batch_size=4, pause_secs=0.0)
    return flag, path


def frame(spark, n=20, parts=3):
    return spark.range(n).repartition(parts).select(F.format_string('{"id":%d}', "id").alias("event"))


def outcomes(spark, path):
    return {(r.sink, r.status, r.error_class): (r.n_events, r.attempts >= r.n_requests)
            for r in receiver.receipts(spark, path).collect()}


def test_batch_write(spark, tmp_path):
    flag, path = sink(spark, tmp_path, "try_batch")
    open(flag, "w").close()
    for batch_id in (0, 1, 1):  # a repeated batch replaces its receipts
        frame(spark).write.format("try_batch").mode("append").option("batch_id", batch_id).save()
    kept = receiver.receipts(spark, path).collect()
    assert [(r.sink, r.status, r.error_class, r.n_events) for r in kept] == [("try_batch", "ok", None, 20)] * 2
    assert all(r.n_requests == r.attempts and 5 <= r.n_requests <= 8 for r in kept)


def test_a_failing_task_leaves_no_receipt(spark, tmp_path):
    flag, path = sink(spark, tmp_path, "try_failing")
    with pytest.raises(Exception, match="after 3 attempts"):
        frame(spark).write.format("try_failing").mode("append").save()
    assert not os.path.exists(path)
    open(flag, "w").close()
    frame(spark).write.format("try_failing").mode("append").save()
    assert outcomes(spark, path) == {("try_failing", "ok", None): (20, True)}


def test_refusals_are_counted(spark, tmp_path):
    _, path = sink(spark, tmp_path, "try_refusing", code=422)
    frame(spark, parts=1).write.format("try_refusing").mode("append").save()
    assert outcomes(spark, path) == {
        ("try_refusing", "ok", None): (16, True), ("try_refusing", "error", "http"): (4, True)}


def test_no_events(spark, tmp_path):
    _, path = sink(spark, tmp_path, "try_empty")
    frame(spark, 0).write.format("try_empty").mode("append").save()
    assert receiver.receipts(spark, path).count() == 0


def test_a_retried_batch_of_a_stream_has_one_receipt(spark, tmp_path):
    flag, path = sink(spark, tmp_path, "try_stream")
    for i in range(2):
        frame(spark).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        source = spark.readStream.schema("event string").option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in"))
        source.writeStream.format("try_stream").trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()

    with pytest.raises(Exception, match="after 3 attempts"):
        run()
    assert not os.path.exists(path)
    open(flag, "w").close()
    run()
    run()  # nothing new
    kept = receiver.receipts(spark, path).groupBy("sink", "status").agg(F.sum("n_events").alias("n")).collect()
    assert [tuple(r) for r in kept] == [("try_stream", "ok", 40)]
    assert sorted(os.listdir(path)) == ["batch-0.parquet", "batch-1.parquet"]


@pytest.mark.parametrize("uri", ["{}", "file://{}"])
def test_receipts_path_may_be_a_uri(spark, tmp_path, uri):
    path = uri.format(tmp_path / "receipts")
    receiver.register(spark, "try_uri", lambda: Flagged("/", 200), path)
    frame(spark).write.format("try_uri").mode("append").save()
    assert receiver.receipts(spark, path).agg(F.sum("n_events")).first()[0] == 20
