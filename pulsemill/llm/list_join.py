"""URL filtering against dated lists: every capture sees the list as of its fetch time.

A list is a log of entries (pattern, action, time). Entries of one pattern follow each
other, so each is valid from its own time to that of the next; the result is a table of
disjoint validity intervals. A capture carries the patterns that can match it (every
domain suffix of its host, every path prefix of its URL) and meets the intervals of those
patterns that hold its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.common import saved

SLOTS = 1 << 24  # bits that screen what can be in a list
BUCKET_SECONDS = 30 * 86_400  # captures and intervals meet by pattern and bucket of time
BLOCK, ALLOW = "block", "allow"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, or trailing dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(authority, r"^[^@]*@|:[0-9]*$|\.$", ""))


def path_of(url: Column) -> Column:
    """Path without query and fragment, beginning with a slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def patterns(url: Column, labels: list[int] | None = None, slashes: list[int] | None = None) -> Column:
    """Patterns that can match a URL.

    ``d:`` and a domain: the host or a suffix of it at a dot. ``p:`` and host with path: a
    prefix of the path at a slash, or the whole path. With ``labels`` and ``slashes``, the
    numbers of labels of a list's domains and of slashes in its paths, only patterns of such
    shapes are built: all that can be in the list, a few strings however long the URL is.
    """
    parts, names = F.split(path_of(url), "/"), F.split(host_of(url), r"\.")
    n, m = F.size(names), F.size(parts)
    if labels is None or slashes is None:
        domains, depths = F.sequence(F.lit(1), n), F.sequence(F.lit(1), m)
    else:
        domains = F.filter(F.lit(labels).cast("array<int>"), lambda k: k <= n)
        depths = F.filter(F.lit(slashes).cast("array<int>"), lambda k: k < m)
    suffixes = F.transform(
        domains, lambda k: F.concat(F.lit("d:"), F.array_join(F.slice(names, n - k + 1, k), ".")))
    # a path of m parts has m - 1 slashes; a prefix that ends in its k-th slash has k
    prefixes = F.transform(
        F.filter(depths, lambda k: k < m),
        lambda k: F.concat(F.lit("p:"), host_of(url), F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))
    whole = F.when(
        F.array_contains(depths, m - 1) if slashes is not None else F.lit(True),
        F.array(F.concat(F.lit("p:"), host_of(url), path_of(url)))).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url) != "", F.array_distinct(F.concat(suffixes, prefixes, whole))).otherwise(
        F.array().cast("array<string>"))


def shapes(entries: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels in the list's domains, of slashes in its paths.

    k different numbers need a list of k * k / 2 characters, so there are few.
    """
    pattern = F.col("pattern")

    def numbers(kind: str, sign: str) -> Column:
        return F.collect_set(F.when(pattern.startswith(kind), F.length(pattern) - F.length(F.replace(pattern, F.lit(sign)))))

    dots, slashes = entries.agg(numbers("d:", "."), numbers("p:", "/")).first()
    return [k + 1 for k in sorted(dots)], sorted(slashes)


def _slot(pattern: str) -> Column:
    return F.pmod(F.xxhash64(pattern), F.lit(SLOTS))


def listed_only(probes: DataFrame, entries: DataFrame) -> DataFrame:
    """Probes whose pattern may be in the list: its bit is set in a table of the list's hashes.

    The table has a fixed size (2 MB), so it can be broadcast with any list; a list of many
    millions of patterns fills it and lets more pass, which the join then decides.
    """
    slot = _slot("pattern")
    table = entries.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    met = probes.withColumn("page", F.bitmap_bucket_number(slot)).join(F.broadcast(table), "page")
    return met.where(F.getbit(byte, (place % 8).cast("int")) == 1).drop("page", "bits")


def intervals(entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Rows (pattern, action, valid_from, valid_to) from entries (pattern, action, at).

    Times are seconds; valid_to is null for the last entry of a pattern. Of entries of one
    pattern at one time a block counts before an allow, and that before any other action,
    which removes the pattern. Entries without pattern or time are left out.

    The next entry is looked up within a time bucket, for the last of a bucket among the
    first entries of the pattern's buckets: no task sorts all entries of a busy pattern.
    """
    rank = F.when(F.col("action") == BLOCK, 0).when(F.col("action") == ALLOW, 1).otherwise(2)
    single = (
        entries.where("pattern is not null and at is not null").groupBy("pattern", "at")
        .agg(F.min(F.struct(rank.alias("rank"), F.col("action"))).alias("first"))
        .select("pattern", "at", F.col("first.action").alias("action"),
                F.floor(F.col("at") / bucket_seconds).alias("bucket")))
    heads = single.groupBy("pattern", "bucket").agg(F.min("at").alias("head"))
    by_bucket = Window.partitionBy("pattern").orderBy("bucket")
    heads = heads.select("pattern", "bucket", F.lead("head").over(by_bucket).alias("later"))
    follows = Window.partitionBy("pattern", "bucket").orderBy("at")
    return single.join(heads, ["pattern", "bucket"]).select(
        "pattern", "action", F.col("at").alias("valid_from"),
        F.coalesce(F.lead("at").over(follows), "later").alias("valid_to"),
    ).where(F.col("action").isin(BLOCK, ALLOW))


def as_of(
    captures: DataFrame, entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Captures (page_id, url, fetched_at) with the entry that decides, and ``blocked``.

    Of the intervals that hold the fetch time the one with the most specific pattern
    decides: a path before a domain, then the longer one. Both ends are UTC seconds, the
    start belongs to an interval, its end does not. Without a match, a URL or a fetch time
    a capture is not blocked and its pattern is null. Repeated captures are looked up once
    and come back as often as they were.

    Captures and intervals meet by pattern and time bucket. An interval is listed only in
    the buckets from its start to its end or to the last bucket of any capture, so what a
    busy pattern brings together is bounded by one bucket; buckets also split the captures
    of a frequent host, and skewed joins split the rest. Only patterns of shapes the list has
    are built and only those whose hash is in the list move, so a very long URL gives a few
    short rows.
    """
    entries = saved(entries.where("pattern is not null and at is not null").select("pattern", "action", "at"), "list")
    # how often each capture comes, found before anything is joined
    distinct = captures.groupBy("page_id", "url", "fetched_at").agg(F.count("*").alias("times"))
    bucket = F.floor(F.col("fetched_at") / bucket_seconds)
    probes = listed_only(distinct.drop("times").withColumn("bucket", bucket).withColumn(
        "pattern", F.explode(patterns(F.col("url"), *shapes(entries)))), entries)
    ends = captures.agg(
        F.floor(F.min("fetched_at") / bucket_seconds), F.floor(F.max("fetched_at") / bucket_seconds)).first()
    low, high = (0, -1) if ends[0] is None else ends
    first = F.greatest(F.floor(F.col("valid_from") / bucket_seconds), F.lit(low))
    last = F.least(F.floor((F.col("valid_to") - 1) / bucket_seconds), F.lit(high))
    last = F.coalesce(last, F.lit(high))
    listed = intervals(entries, bucket_seconds).withColumn("first", first).withColumn("last", last).where(
        "first <= last").withColumn("bucket", F.explode(F.sequence("first", "last"))).drop("first", "last")
    active = (F.col("fetched_at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    hits = probes.join(listed, ["pattern", "bucket"]).where(active).groupBy(
        F.col("page_id").alias("page_"), F.col("url").alias("url_"), F.col("fetched_at").alias("at_"),
    ).agg(F.max(F.struct(
            F.col("pattern").startswith("p:").alias("path"), F.length("pattern").alias("length"),
            "pattern", "action", "valid_from")).alias("hit"))
    same = F.expr("page_id <=> page_ and url <=> url_ and fetched_at <=> at_")
    joined = distinct.join(hits, same, "left")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "page_id", "url", "fetched_at", F.col("hit.pattern").alias("pattern"),
        F.col("hit.action").alias("action"), F.col("hit.valid_from").alias("valid_from"),
        F.coalesce(F.col("hit.action") == BLOCK, F.lit(False)).alias("blocked"))
