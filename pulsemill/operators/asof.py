"""As-of enrichment: the batch twin of the streaming join.

An event takes the newest content version that arrived before it.  An event
that came before the first version of its item takes that first version if it
was still waiting for it, else it is missing.  It is still waiting when no two
consecutive arrivals of the item, from the event to that version, lie further
apart than the wait: every buffered event restarts it.

Plan: both feeds are merged into one timeline and swept once per group with
window functions, so nothing is paired.  A group is an item or, for an item
with very many rows, a slice of its timeline.  Slices are cut by counted rows: bins that
hold too many are cut again between their own least and greatest number, so a slice is
bounded however unevenly the numbers lie.  What a slice must know of the others (version
in force, first version, next arrival, a later break) comes from a summary with one row
per slice and enters as a first row.

The feeds are read twice: to count the rows of the items, and for the sweep.  If an item
has very many rows, the second reading writes the timeline and the rest reads that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.operators.enrich import ATTRIBUTES, finish
from pulsemill.operators.skew import HOT_ROWS
from pulsemill.session import written

_CARRY, _CONTENT, _EVENT = 0, 1, 2
SLICE_ROWS = 1_000_000
BINS_PER_SLICE = 4
FAN = 64  # ranges of an item, or blocks of them, that are looked at together


def _timeline(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Both feeds as rows (content_id, seq, kind, arrival, version, event); a delete has no version."""
    version = F.struct(F.col("seq").alias("seq"), *[F.col(c) for c in ATTRIBUTES])
    if "deleted" in versions.columns:
        version = F.when(~F.coalesce("deleted", F.lit(False)), version)
    content_rows = versions.select(
        F.col("id").alias("content_id"), "seq", F.lit(_CONTENT).alias("kind"),
        F.unix_micros(F.col("arrival_ts").cast("timestamp")).alias("arrival"),
        version.alias("version"),
    )
    event_rows = events.select(
        "content_id", "seq", F.lit(_EVENT).alias("kind"),
        F.unix_micros(F.col("arrival_ts").cast("timestamp")).alias("arrival"),
        F.struct(*[F.col(c) for c in events.columns]).alias("event"),
    )
    return event_rows.unionByName(content_rows, allowMissingColumns=True)


def _in_range(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with ``range``: the range of their item that begins last at ``seq`` or before, null if none does.

    Ranges (content_id, low, ...) are looked up in a tree of blocks of at most ``FAN``, a join a level,
    so a row meets few of them however many its item has. The tree has a row per block and may be
    broadcast.
    """
    along = Window.partitionBy("content_id").orderBy("low")
    rest = [c for c in ranges.columns if c not in ("content_id", "low")]
    number = F.row_number().over(along).cast("bigint") - 1
    leaves = ranges.withColumn("block", F.floor(number / FAN)).groupBy("content_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("low", *rest))).alias("entries"))
    leaves = written(leaves, "ranges")
    level = leaves.select("content_id", "block", F.col("entries")[0]["low"].alias("low"))
    branches = level.groupBy("content_id", F.floor(F.col("block") / FAN).alias("branch")).agg(
        F.array_sort(F.collect_list("low")).alias("lows"))
    root = branches.groupBy("content_id").agg(F.array_sort(F.collect_list(F.col("lows")[0])).alias("lows"))

    def place(lows: str, low: Callable[[Column], Column] = lambda x: x) -> Column:
        return F.size(F.filter(lows, lambda x: low(x) <= F.col("seq"))).cast("bigint") - 1

    rows = rows.join(F.broadcast(root), "content_id", "left").withColumn("branch", place("lows")).drop("lows")
    rows = rows.join(F.broadcast(branches), ["content_id", "branch"], "left").withColumn(
        "block", F.col("branch") * FAN + place("lows")).drop("branch", "lows")
    rows = rows.join(F.broadcast(leaves), ["content_id", "block"], "left").withColumn(
        "range", F.get("entries", place("entries", lambda x: x["low"]).cast("int")))
    return rows.drop("block", "entries")


def _bins(rows: DataFrame, slice_rows: int) -> DataFrame:
    """Bins (content_id, low, high, n) of hot items, each of a part of a slice or of one number.

    ``low`` and ``high`` are numbers that occur.  A bin with too many rows is cut into equal
    widths as often as needed; every round at least halves it, and counts are all that is
    shuffled.  There are at most a few bins for every slice, so they may be broadcast.
    """
    most = max(1, slice_rows // BINS_PER_SLICE)
    counts = [F.min("seq").alias("low"), F.max("seq").alias("high"), F.count("*").alias("n")]
    bins = written(rows.groupBy("content_id").agg(*counts), "bins")
    while True:
        full = (F.col("n") > most) & (F.col("low") < F.col("high"))
        if bins.where(full).isEmpty():
            return bins
        width = F.expr(f"(high - low) div ceil(n / {most}) + 1").alias("width")
        found = _in_range(rows, bins.where(full).select("content_id", "low", "high", width)).where("seq <= range.high")
        cut = found.groupBy("content_id", F.col("range.low").alias("first"), F.expr(
            "(seq - range.low) div range.width").alias("part")).agg(*counts).select(*bins.columns)
        bins = written(bins.where(~full).unionByName(cut), "bins")


def _sliced(timeline: DataFrame, hot_rows: int, slice_rows: int) -> DataFrame:
    """The timeline with ``slice``, and with ``hot`` if there is an item of more than ``hot_rows`` rows.

    A slice of a hot item has fewer than ``slice_rows`` rows and a bin more.  Rows without
    item wait for nothing; each is a slice of its own.
    """
    alone = F.when(F.col("content_id").isNull(), F.xxhash64("seq"))
    counts = timeline.where(F.col("content_id").isNotNull()).groupBy("content_id").agg(F.count("*").alias("n"))
    # at most one hot item for each hot_rows rows, so this may be broadcast
    hot = written(counts.where(F.col("n") > hot_rows).select("content_id", F.lit(True).alias("hot")), "hot")
    if hot.isEmpty():
        return timeline.withColumn("slice", F.coalesce(alone, F.lit(0).cast("bigint")))
    marked = timeline.join(F.broadcast(hot), "content_id", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    timeline = written(marked, "timeline", "hot")
    before = Window.partitionBy("content_id").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    numbered = _bins(timeline.where("hot").select("content_id", "seq"), slice_rows).withColumn(
        "slice", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / slice_rows))
    cuts = numbered.groupBy("content_id", "slice").agg(F.min("low").alias("low"))
    return _in_range(timeline, cuts).withColumn(
        "slice", F.coalesce(alone, "range.slice", F.lit(0).cast("bigint"))).drop("range")


def _turns(rows: DataFrame, ttl_us: int | None) -> DataFrame:
    """Rows with ``turn``: one where the item, known so far, is not known any more.

    That is so at a delete, and at the first row after the content's lifetime. The state
    before a row is the newest content row or delete and the arrival of the row before;
    the first row of a slice has both from ``carried``.
    """
    ordered = Window.partitionBy("content_id", "slice").orderBy("seq", "kind")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    gone = (F.col("kind") == _CONTENT) & F.col("version").isNull()
    change = F.when(F.col("kind") == _CONTENT, F.struct(~gone, "arrival"))
    rows = rows.withColumn("newest", F.coalesce(
        F.last(change, ignorenulls=True).over(earlier), F.col("carried.newest")))
    known, since = F.coalesce(F.col("newest.col1"), F.lit(False)), F.col("newest.arrival")
    turn = gone
    if ttl_us is not None:
        rows = rows.withColumn("previous", F.coalesce(F.lag("arrival").over(ordered), F.col("carried.arrival")))
        known &= F.col("previous") - since < ttl_us
        turn |= F.col("arrival") - since >= ttl_us
    return rows.withColumn("turn", (known & turn).cast("int")).drop("newest", "previous")


def _with_epochs(sliced: DataFrame, ttl_us: int | None) -> DataFrame:
    """The timeline without deletes, and with ``epoch``: how often the item has become unknown so far.

    Events of an epoch see and wait for its versions only, so an epoch of an item is
    enriched like an item. Slices of a hot item learn from narrow tables, with one row per
    slice, the state they begin with and the epochs before.
    """
    group = ["content_id", "slice"]
    gone = (F.col("kind") == _CONTENT) & F.col("version").isNull()
    so_far = Window.partitionBy(*group).orderBy("seq", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    epoch = F.sum("turn").over(so_far)
    if "hot" not in sliced.columns:
        start = F.lit(None).cast("struct<newest: struct<col1: boolean, arrival: bigint>, arrival: bigint>")
        rows = _turns(sliced.withColumn("carried", start), ttl_us)
        return rows.withColumn("epoch", epoch.cast("long")).where(~gone).drop("carried", "turn")
    along = Window.partitionBy("content_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    change = F.when(F.col("kind") == _CONTENT, F.struct(~gone, "arrival"))
    hot = sliced.where("hot").select(*group, "seq", "kind", "arrival", "version")
    ends = hot.groupBy(*group).agg(
        F.max_by(change, F.when(F.col("kind") == _CONTENT, F.col("seq"))).alias("newest"),
        F.max_by("arrival", F.struct("seq", "kind")).alias("arrival"))
    carried = ends.select(*group, F.struct(
        F.last("newest", ignorenulls=True).over(along).alias("newest"),
        F.last("arrival").over(along).alias("arrival")).alias("carried"))
    turns = _turns(hot.join(F.broadcast(carried), group), ttl_us).groupBy(*group).agg(F.sum("turn").alias("n"))
    carried = carried.join(
        turns.select(*group, F.coalesce(F.sum("n").over(along), F.lit(0)).alias("epochs_before")), group)
    rows = _turns(sliced.join(F.broadcast(carried), group, "left"), ttl_us)
    epoch = F.coalesce("epochs_before", F.lit(0)) + epoch
    return rows.withColumn("epoch", epoch.cast("long")).where(~gone).drop("carried", "epochs_before", "turn")


def _slice_summary(sliced: DataFrame, wait_us: int | None, group: list[str]) -> DataFrame:
    """One carried row per slice of a hot item (and epoch)."""
    item = group[:-1]
    rows = sliced.select(*group, "seq", "kind", "arrival", "version")
    content_seq = F.when(F.col("kind") == _CONTENT, F.col("seq"))
    if wait_us is not None:
        inside = Window.partitionBy(*group)
        ordered = inside.orderBy("seq", "kind")
        rows = rows.withColumn("gap", F.lead("arrival").over(ordered) - F.col("arrival"))
        rows = rows.withColumn("first_content", F.min(content_seq).over(inside))
        before = F.col("first_content").isNull() | (F.col("seq") < F.col("first_content"))
        rows = rows.withColumn("broken", before & (F.col("gap") > wait_us))
    else:
        rows = rows.withColumn("broken", F.lit(False))
    slices = rows.groupBy(*group).agg(
        F.max("version").alias("last_version"),
        F.min("version").alias("first_version"),
        F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"),
        F.coalesce(F.max("broken"), F.lit(False)).alias("broken"),
    )
    along = Window.partitionBy(*item).orderBy("slice")
    back = Window.partitionBy(*item).orderBy(F.desc("slice"))
    whole = Window.partitionBy(*item)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        slices.withColumn("carried", F.last("last_version", ignorenulls=True).over(earlier))
        .withColumn("next_arrival", F.lead("first_arrival").over(along))
        .withColumn("key_first", F.min("first_version").over(whole))
        .withColumn(
            "content_slice",
            F.min(F.when(F.col("first_version").isNotNull(), F.col("slice"))).over(whole),
        )
    )
    if wait_us is None:
        later_break = F.lit(False)
    else:
        # A break inside a slice or on its way to the next, up to the slice of
        # the first version.
        breaks = (F.col("slice") <= F.col("content_slice")) & (
            F.col("broken")
            | (
                (F.col("slice") < F.col("content_slice"))
                & (F.col("next_arrival") - F.col("last_arrival") > wait_us)
            )
        )
        slices = slices.withColumn("breaks", F.coalesce(breaks, F.lit(False)))
        later_break = F.coalesce(F.max("breaks").over(later), F.lit(False))
    return slices.select(
        *group, F.lit(-1).cast("bigint").alias("seq"), F.lit(_CARRY).alias("kind"),
        F.col("carried").alias("version"), F.col("key_first"), F.col("next_arrival"),
        later_break.alias("later_break"),
    )


def enrich_asof(
    events: DataFrame,
    versions: DataFrame,
    pending_ttl_secs: float | None = None,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    content_ttl_secs: float | None = None,
) -> DataFrame:
    """Enrich recorded events as the stream would have.

    ``events`` has ``seq`` and ``arrival_ts`` beside the engagement columns,
    ``versions`` has ``id``, ``seq``, ``arrival_ts`` and the content attributes.
    ``seq`` is the arrival number of both feeds: not negative, unique within a
    feed, ascending with ``arrival_ts``.  A version with an event's number is
    taken to have come first.  Without ``pending_ttl_secs`` events wait for ever.
    Adds ``drained``: the event had to wait for its content.

    A version row that is ``deleted``, if that column is there, ends what was known of its
    item. So does ``content_ttl_secs`` without a new version. Events after that wait anew.
    """
    for df in (events, versions):
        if "arrival_ts" not in df.columns and (pending_ttl_secs is not None or content_ttl_secs is not None):
            raise ValueError("a bounded wait or lifetime needs arrival_ts in both feeds")
    events = _with_arrival(events)
    versions = _with_arrival(versions)
    wait_us = None if pending_ttl_secs is None else int(pending_ttl_secs * 1_000_000)

    sliced = _sliced(_timeline(events, versions.where(F.col("id").isNotNull())), hot_rows, slice_rows)
    keys = ["content_id", "slice"]
    if "deleted" in versions.columns or content_ttl_secs is not None:
        sliced = _with_epochs(sliced, None if content_ttl_secs is None else int(content_ttl_secs * 1_000_000))
        keys = ["content_id", "epoch", "slice"]
    if "hot" in sliced.columns:
        summary = _slice_summary(sliced.where(F.col("hot")), wait_us, keys)
        rows = sliced.drop("hot").unionByName(summary, allowMissingColumns=True)
    else:
        rows = sliced.withColumns({
            "key_first": F.lit(None).cast(sliced.schema["version"].dataType),
            "next_arrival": F.lit(None).cast("bigint"), "later_break": F.lit(None).cast("boolean")})

    group = Window.partitionBy(*keys)
    ordered = group.orderBy("seq", "kind")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("in_force", F.last("version", ignorenulls=True).over(so_far))
    own = F.when(F.col("kind") == _CONTENT, F.col("version"))
    rows = rows.withColumn("first", F.min(F.coalesce(F.col("key_first"), own)).over(group))
    waited = F.col("in_force").isNull() & F.col("first").isNotNull()
    if wait_us is not None:
        rows = (
            rows.withColumn("after_slice", F.max("next_arrival").over(group))
            .withColumn("broken_later", F.max("later_break").over(group))
            .withColumn("next", F.coalesce(F.lead("arrival").over(ordered), F.col("after_slice")))
        )
        is_break = (
            (F.col("kind") == _EVENT) & (F.col("seq") < F.col("first.seq"))
            & (F.col("next") - F.col("arrival") > wait_us)
        )
        rows = rows.withColumn("last_break", F.max(F.when(is_break, F.col("seq"))).over(group))
        waited &= ~F.coalesce(F.col("broken_later"), F.lit(False))
        waited &= F.col("last_break").isNull() | (F.col("seq") > F.col("last_break"))

    rows = rows.where(F.col("kind") == _EVENT).withColumn("drained", waited)
    chosen = F.when(F.col("drained"), F.col("first")).otherwise(F.col("in_force"))
    joined = rows.withColumn("chosen", chosen).select(
        "event.*", *[F.col(f"chosen.{c}").alias(c) for c in ATTRIBUTES],
        F.col("chosen").isNotNull().alias("found"), "drained",
    )
    return finish(joined)


def _with_arrival(df: DataFrame) -> DataFrame:
    if "arrival_ts" in df.columns:
        return df
    return df.withColumn("arrival_ts", F.lit(None).cast("timestamp"))
