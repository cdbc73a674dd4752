"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a two-part key. Splitters are found without sorting: exact bytes below
equally spaced probes are counted over all partitions, every splitter's interval shrinks to
the probes around its target, and this repeats until a boundary is within the tolerance.
Then the rows are exchanged once, by range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.common import saved, set_aside, text_bytes

N_SHARDS = 40
TOLERANCE = 0.005  # of a shard's bytes
PROBE_BITS = 8
ROW_BITS = 24  # of the second key part, for rows that are equal otherwise
_LEAST = -(1 << 63)
_MASK = (1 << 64) - 1


@dataclass
class _Open:
    """A splitter still looked for: its target lies in the keys that begin with ``prefix``."""

    target: float
    below: int = 0  # bytes before the interval
    prefix: int = 0
    bits: int = 0
    high: int | None = None  # the only first key part left, once the second is searched


def _unsigned(key: str) -> Column:
    """Bits of a long, the least long being all zeros."""
    return F.col(key).bitwiseXOR(F.lit(_LEAST))


def _counts(keys: DataFrame, column: str, bits: int, probe: int) -> DataFrame:
    """Bytes per prefix of ``bits`` and the next ``probe`` bits, with the extreme keys."""
    whole = _unsigned(column)
    prefix = F.shiftrightunsigned(whole, 64 - bits) if bits else F.lit(0).cast("long")
    step = F.shiftrightunsigned(whole, 64 - bits - probe).bitwiseAND(F.lit((1 << probe) - 1))
    return keys.withColumn("prefix", prefix).withColumn("step", step)


def _as_long(unsigned: int) -> int:
    return ((unsigned ^ (1 << 63)) & _MASK) - ((1 << 64) if (unsigned ^ (1 << 63)) & (1 << 63) else 0)


def _prefix_lit(unsigned_prefix: int) -> int:
    """A 64-bit prefix as the long that Spark sees."""
    return unsigned_prefix - (1 << 64) if unsigned_prefix >> 63 else unsigned_prefix


def splitters(
    keys: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE,
    major: str = "major", minor: str = "minor", size: str = "size",
) -> list[tuple[int, int]]:
    """The n_shards - 1 first keys of the shards after the first.

    Each has bytes below it that differ from its target by at most ``tolerance`` shards, or
    is the boundary next to the target where no key boundary is that close (rows with equal
    keys stay together). Equal ``major`` keys are divided only where the tolerance needs it.
    Per round at most n_shards * 2^PROBE_BITS counts reach the driver.
    """
    total = keys.agg(F.sum(size)).first()[0]
    if not total:
        return []
    allowed = tolerance * total / n_shards
    found: dict[int, tuple[int, int]] = {}
    wanted = {j: _Open(total * j / n_shards) for j in range(1, n_shards)}
    while wanted:
        for second in (False, True):
            levels = {(x.high is not None, x.bits) for x in wanted.values()}
            for bits in sorted(b for s, b in levels if s == second):
                own = {j: x for j, x in wanted.items() if (x.high is not None, x.bits) == (second, bits)}
                _refine(keys, own, bits, allowed, found, (major, minor, size))
                wanted = {j: x for j, x in wanted.items() if j not in found}
    return [found[j] for j in range(1, n_shards)]


def _refine(keys, own, bits, allowed, found, names) -> None:
    """Count below the next probes of these intervals; settle or narrow each."""
    major, minor, size = names
    second = next(iter(own.values())).high is not None
    column = minor if second else major
    rows = _counts(keys, column, bits, PROBE_BITS)
    if bits:
        rows = rows.where(F.col("prefix").isin(sorted({_prefix_lit(x.prefix) for x in own.values()})))
    group = ["prefix", "step"]
    if second:
        rows = rows.where(F.col(major).isin(sorted({x.high for x in own.values()})))
        group.insert(0, major)
    bins: dict = {}
    for r in rows.groupBy(*group).agg(
            F.sum(size).alias("bytes"), F.min(column).alias("low"), F.max(column).alias("top")).collect():
        bins.setdefault((r[major] if second else None, r.prefix), []).append(r)
    for j, x in own.items():
        below, best, inner = x.below, None, None
        steps = sorted(bins[(x.high, _prefix_lit(x.prefix))], key=lambda r: r.step)
        for r in steps:
            if best is None or abs(below - x.target) < abs(best[0] - x.target):
                best = (below, r.low)
            if below <= x.target < below + r.bytes:
                inner = (below, r)
            below += r.bytes
        if inner is None:  # the target is the end of the interval: rounding of the last row
            inner = (below - steps[-1].bytes, steps[-1])
        if abs(best[0] - x.target) <= allowed:
            found[j] = (x.high, best[1]) if second else (best[1], _LEAST)
            continue
        start, r = inner
        if r.low < r.top:
            whole = (r.low ^ _LEAST) & _MASK
            x.below, x.bits = start, bits + PROBE_BITS
            x.prefix = whole >> (64 - x.bits)
        elif not second:
            x.below, x.high, x.prefix, x.bits = start, r.low, 0, 0
        else:  # one key value on both sides: the nearer end
            end = start + r.bytes
            near = x.target - start <= end - x.target
            found[j] = (x.high, r.low) if near else (x.high, min(r.low + 1, (1 << 63) - 1))


def shard_of(bounds: list[tuple[int, int]], major: str = "major", minor: str = "minor") -> Column:
    """Number of splitters at or below the key."""
    shard = F.lit(0)
    for high, low in bounds:
        after = F.col(major) > high
        same = F.col(major) == high
        if low != _LEAST:
            same = same & (F.col(minor) >= low)
        shard = shard + (after | same).cast("int")
    return shard


def sharded(
    rows: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Rows with ``shard`` and ``slot``, from rows with major, minor (long) and size.

    Slots number the rows of a shard from 0 in key order. The rows are written once before
    the probes and once, sorted, after the exchange; what joins back the first slot of each
    partition and shard has at most partitions + shards rows.
    """
    # the low bits number the written rows, so that rows with equal keys can be divided too
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long"))
    minor = F.col("minor").bitwiseAND(F.lit(-(1 << ROW_BITS)).cast("long")).bitwiseOR(number)
    keyed = saved(rows.drop("shard", "slot").withColumn("minor", minor), "keyed")
    bounds = splitters(keyed.select("major", "minor", "size"), n_shards, tolerance)
    order = ["shard", "major", "minor"]
    ranged = saved(
        keyed.withColumn("shard", shard_of(bounds)).repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("part", F.shiftrightunsigned("at", 33))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part", "shard").agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    ).select("part", "shard", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ranged.join(F.broadcast(starts), ["part", "shard"]).withColumn(
        "slot", F.col("at") - F.col("first") + F.col("before")
    ).drop("part", "at", "first", "before")


def sharded_documents(
    docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Documents with shard, slot, size and text_crc32, ordered by the hash of their text.

    Equal texts are neighbours, so they share a shard unless they hold more than twice the
    tolerance. Size is UTF-8 bytes plus 16; a null text counts as empty. Repeated rows each
    get a slot and are divided like other copies; a null doc_id is ordered as 0. Columns of these names are replaced, others stay.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.drop("shard", "slot", "size", "text_crc32")
    keyed = set_aside(docs, "doc_id", "text").select(
        "*", (text_bytes("text") + 16).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("major"), F.xxhash64(F.coalesce("doc_id", F.lit(0))).alias("minor"))
    new = ("size", "text_crc32", "shard", "slot")
    return sharded(keyed, n_shards, tolerance).select(
        *keyed.columns[:len(docs.columns)], *new).toDF(*docs.columns, *new)


def shard_rows(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The digest of ``sharded_documents``, which exchanges only ids, sizes and checksums."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id", (text_bytes("text") + 16).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("major"), F.xxhash64(F.coalesce("doc_id", F.lit(0))).alias("minor"))
    return sharded(keyed, n_shards, tolerance).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
