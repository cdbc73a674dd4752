"""Windows and deduplication over a stream of files with late and repeated rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import windows
from pulsemill.session import STATE_SETTINGS, temporary_conf

SCHEMA = "id long, event_ts timestamp, device string, seq long"


def rows(*specs):
    return [{"id": i, "event_ts": f"2024-01-01T{at}:00Z", "device": d, "seq": s} for i, at, d, s in specs]


#: One file per micro-batch: the second repeats and is late within the watermark, the last has a row too late.
FILES = [
    rows((1, "10:00", "ios", 1), (2, "10:10", "tv", 2), (2, "10:10", "tv", 3), (3, "10:50", "tv", 4)),
    rows((1, "10:00", "ios", 5), (4, "10:20", "ios", 6), (5, "12:30", "ios", 7)),
    rows((7, "13:00", "tv", 9), (5, "12:30", "ios", 10)),
    rows((6, "10:30", "tv", 8), (8, "16:00", "tv", 11)),
]


@pytest.fixture
def stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n, lines in enumerate(FILES):
        (folder / f"{n}.json").write_text("\n".join(map(json.dumps, lines)) + "\n")
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # read in this order

    def run(transform):
        out = str(tmp_path / "out")
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        with temporary_conf(spark, {**STATE_SETTINGS, "spark.sql.shuffle.partitions": "2"}):
            transform(source).writeStream.format("parquet").option("path", out).option(
                "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out)

    return run


def batch(spark, drop=()):
    lines = [json.dumps(r) for f in FILES for r in f if r["seq"] not in drop]
    return spark.createDataFrame([(x,) for x in lines], "value string").select(
        F.from_json("value", SCHEMA).alias("r")).select("r.*")


def test_windows_close_behind_the_watermark(spark, stream):
    got = stream(lambda s: windows.tumbling_counts(s, "1 hour", "1 hour", "device"))
    # 10:30 came after 13:00 less an hour: too late; the windows of 16:00 are still open
    want = windows.tumbling_counts(batch(spark, drop=(8, 11)), "1 hour", None, "device")
    assert sorted(got.collect()) == sorted(want.collect())


def test_repeats_within_the_watermark_are_dropped(spark, stream):
    got = stream(lambda s: windows.dedup_events(s, "1 hour"))
    want = windows.dedup_events(batch(spark, drop=(8,)))
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


def test_ties_of_position_are_decided(spark):
    data = [(1, None, d, 5) for d in ("tv", "ios", "web")]
    for n in (1, 3):
        df = spark.createDataFrame(data[::-1] if n == 3 else data, SCHEMA).repartition(n)
        assert windows.dedup_events(df).first().device == "ios"
