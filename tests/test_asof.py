import bisect
import random

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import asof
from pulsemill.operators.asof import _sliced, enrich_asof
from tests.test_enrich import events

WAIT = 10


def simulate(arrivals, wait, ttl=None):
    """The state machine, one arrival at a time: {event id: (type, drained)}."""
    known, pending, due, out, since = {}, {}, {}, {}, {}

    def flush(now):
        for key in [k for k, t in due.items() if t < now]:
            for event in pending.pop(key):
                out[event] = (None, False)
            del due[key]

    for seq, at, kind, key, value in arrivals:
        if wait is not None:
            flush(at)
        if ttl is not None and key in known and at - since[key] >= ttl:
            del known[key]
        if kind == "deleted":
            known.pop(key, None)
        elif kind == "content":
            known[key], since[key] = value, at
            for event in pending.pop(key, []):
                out[event] = (value, True)
            due.pop(key, None)
        elif key in known:
            out[value] = (known[key], False)
        else:
            pending.setdefault(key, []).append(value)
            due[key] = at + (wait or 0)
    for waiting in pending.values():
        for event in waiting:
            out[event] = (None, False)
    return out


def recorded(seed, n=600):
    """Random interleaving of two feeds; one key has a third of all rows."""
    rng = random.Random(seed)
    arrivals, at = [], 0
    for seq in range(n):
        at += rng.choice([0, 1, 1, 2, 3, 8, 12]) if rng.random() < 0.5 else 0
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(60)}"
        late = key != "hot" or seq > n * rng.choice([0.2, 0.6])
        if late and rng.random() < 0.12:
            arrivals.append((seq, at, "content", key, f"v{seq}"))
        else:
            arrivals.append((seq, at, "main", key, seq))
    return arrivals


def frames(spark, arrivals):
    main = [(v, key, 1_000, seq, at) for seq, at, kind, key, v in arrivals if kind == "main"]
    side = [(key, v, 60, seq, at) for seq, at, kind, key, v in arrivals if kind == "content"]
    ev = events(spark, [(m[0], m[1], m[2]) for m in main]).join(
        spark.createDataFrame([(m[0], m[3], m[4]) for m in main], "id long, seq long, at long"), "id"
    ).withColumn("arrival_ts", F.timestamp_seconds("at")).drop("at")
    ver = spark.createDataFrame(
        side, "id string, content_type string, length_seconds long, seq long, at long"
    ).withColumn("arrival_ts", F.timestamp_seconds("at")).drop("at")
    return ev, ver


def with_deletes(seed, n=600):
    """Some updates become deletes, some of them of items that are not known."""
    rng = random.Random(seed + 100)
    return [(s, at, "deleted" if kind == "content" and rng.random() < 0.4 else kind, key, v)
            for s, at, kind, key, v in recorded(seed, n)]


def frames_with_deletes(spark, arrivals):
    ev, ver = frames(spark, [(s, at, "content" if k == "deleted" else k, key, v) for s, at, k, key, v in arrivals])
    gone = [a[0] for a in arrivals if a[2] == "deleted"]
    return ev, ver.withColumn("deleted", F.col("seq").isin(gone))


@pytest.mark.parametrize("seed, wait, ttl, sizes", [
    (0, None, None, {}), (1, WAIT, 25, {}), (2, WAIT, None, {"hot_rows": 50, "slice_rows": 40}),
    (3, None, 25, {"hot_rows": 2, "slice_rows": 7}), (4, WAIT, 25, {"hot_rows": 2, "slice_rows": 7}),
])
def test_deletes_and_lifetimes_equal_the_state_machine(spark, seed, wait, ttl, sizes):
    arrivals = with_deletes(seed)
    ev, ver = frames_with_deletes(spark, arrivals)
    rows = enrich_asof(ev, ver, wait, content_ttl_secs=ttl, **sizes).collect()
    got = {r.id: (r.content_type, r.drained) for r in rows}
    assert len(rows) == len(got)
    assert got == simulate(arrivals, wait, ttl)
    assert got != simulate([a for a in arrivals if a[2] != "deleted"], wait)


def test_a_lifetime_needs_arrival_times(spark):
    ev, ver = frames(spark, [(1, 1, "main", "a", 1), (2, 2, "content", "a", "v")])
    with pytest.raises(ValueError):
        enrich_asof(ev.drop("arrival_ts"), ver, content_ttl_secs=5)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("wait", [None, WAIT])
@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 50, "slice_rows": 40}, {"hot_rows": 2, "slice_rows": 7}])
def test_equals_the_state_machine(spark, seed, wait, sizes):
    arrivals = recorded(seed)
    ev, ver = frames(spark, arrivals)
    rows = enrich_asof(ev, ver, wait, **sizes).collect()
    got = {r.id: (r.content_type, r.drained) for r in rows}
    assert len(rows) == len(got)
    assert got == simulate(arrivals, wait)


def test_version_of_the_same_number_comes_first(spark):
    ev, ver = frames(spark, [(5, 5, "main", "a", 1), (5, 5, "content", "a", "v")])
    row = enrich_asof(ev, ver).first()
    assert (row.content_type, row.drained, row.content_missing) == ("v", False, False)


def test_events_without_key_are_missing(spark):
    ev, ver = frames(spark, [(1, 1, "main", None, 1), (2, 2, "content", "a", "v")])
    row = enrich_asof(ev, ver).first()
    assert row.content_missing and row.engagement_seconds is None


def test_a_bounded_wait_needs_arrival_times(spark):
    ev, ver = frames(spark, [(1, 1, "main", "a", 1), (2, 2, "content", "a", "v")])
    with pytest.raises(ValueError):
        enrich_asof(ev.drop("arrival_ts"), ver, WAIT)
    assert enrich_asof(ev.drop("arrival_ts"), ver.drop("arrival_ts")).first().drained


def test_one_shuffle_of_the_events_and_no_pairs(spark, tmp_path):
    ev, ver = frames(spark, recorded(0, 100))
    for name, df in (("ev", ev), ("ver", ver)):
        df.write.parquet(str(tmp_path / name))
    ev, ver = (spark.read.parquet(str(tmp_path / n)) for n in ("ev", "ver"))
    plan = enrich_asof(ev, ver, WAIT, hot_rows=10, slice_rows=7)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    executed = enrich_asof(ev, ver, WAIT)._jdf.queryExecution().executedPlan().toString()
    lines = executed.splitlines()
    wide = [line for line in lines if "Exchange hashpartitioning(content_id" in line and "slice" in line]
    # The sweep, and the slim pass over hot rows that prepares the summary (twice by slice).
    assert 1 <= len(wide) <= 3


def test_each_feed_is_scanned_once_after_the_count(spark, tmp_path):
    ev, ver = frames(spark, recorded(0, 100))
    for name, df in (("ev", ev), ("ver", ver)):
        df.write.parquet(str(tmp_path / name))
    ev, ver = (spark.read.parquet(str(tmp_path / n)) for n in ("ev", "ver"))
    for sizes, scans in (({}, 1), ({"hot_rows": 10, "slice_rows": 7}, 0)):
        plan = enrich_asof(ev, ver, WAIT, **sizes)._jdf.queryExecution().sparkPlan().toString()
        for name in ("ev", "ver"):
            assert plan.count(f"{tmp_path}/{name}]") == scans, plan


@pytest.mark.parametrize("numbers", [
    "case when id = 999 then 4000000000000000 else id end",  # one far number
    "case when id < 500 then id else id * 1000000000 end",  # dense, then sparse
    "cast(pow(2, id div 20) * 1000 as bigint) + id",  # ever wider gaps
])
def test_slices_are_bounded_for_uneven_numbers(spark, numbers):
    rows = spark.range(1000).select(F.lit("a").alias("content_id"), F.expr(numbers).alias("seq"))
    sizes = [r["count"] for r in _sliced(rows, 100, 40).groupBy("slice").count().collect()]
    assert max(sizes) < 40 + 10 and sum(sizes) == 1000


def test_one_far_arrival_changes_no_result(spark):
    arrivals = recorded(1) + [(10**12, 10**6, "main", "hot", 10**6), (10**12 + 1, 10**6, "content", "hot", "far")]
    ev, ver = frames(spark, arrivals)
    rows = enrich_asof(ev, ver, WAIT, hot_rows=20, slice_rows=9).collect()
    assert {r.id: (r.content_type, r.drained) for r in rows} == simulate(arrivals, WAIT)


def test_many_events_without_key_share_no_group(spark):
    plain = spark.range(200).select(F.lit(None).cast("string").alias("content_id"), F.col("id").alias("seq"))
    sliced = _sliced(plain, 10, 5)
    assert "hot" not in sliced.columns and sliced.select("slice").distinct().count() == 200


def test_slices_follow_rows_not_numbers(spark):
    """Arrival numbers in microseconds over a year make as many slices as small ones."""
    plain = spark.range(1000).select(F.lit("a").alias("content_id"), F.col("id").alias("seq"))
    for step in (1, 31_536_000_000):
        sliced = _sliced(plain.withColumn("seq", F.col("seq") * step), 100, 50)
        sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
        assert 18 <= len(sizes) <= 20 and max(sizes) <= 100 and sum(sizes) == 1000
        order = [r.slice for r in sliced.orderBy("seq").collect()]
        assert order == sorted(order)


def test_a_row_meets_few_of_many_ranges(spark):
    """Ranges are found through blocks: no row is joined to all ranges of its item."""
    lows = [i * i for i in range(5_000)]
    ranges = spark.createDataFrame([("a", low, i) for i, low in enumerate(lows)], "content_id string, low long, n long")
    rows = spark.range(-3, 25_010_000, 997).select(F.lit("a").alias("content_id"), F.col("id").alias("seq"))
    found = asof._in_range(rows.unionByName(rows.limit(2).withColumn("content_id", F.lit("b"))), ranges)
    for r in found.collect():
        place = bisect.bisect_right(lows, r.seq) - 1
        assert (r.range.n if r.range else -1) == (place if r.content_id == "a" else -1)
    assert ranges.count() > asof.FAN**2
    assert found.select(F.max(F.col("range.n"))).first()[0] == 4_999
