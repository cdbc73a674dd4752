"""Trie of shared conversation prefixes, screened by a count-min sketch of prefix digests.

Every conversation's prefixes are digests. A count-min sketch never counts too low, so an
estimate of one proves that a prefix, and with it all longer ones, belongs to a single
conversation: such tails become nodes where they lie. Only prefixes that may be shared are
shuffled and grouped exactly.

What a subtree sums up follows from one number per conversation. Of a node's members the
smallest owns it, so a conversation owns all nodes of its path from some depth on, and shares
the turns before. A subtree holds as many leaves as members that own a leaf, and saves what
its other members share below the node's parent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.common import saved, small_batches

FAMILY = 5
MOST_SHARED_TURNS = 8
SKETCH_ROWS = 3
CELLS_PER_PREFIX = 4
LEAST_CELL_BITS, MOST_CELL_BITS = 16, 26  # a row of the sketch is at most 8 MB of bits

HOT_CHILDREN = 100_000

_KEY = ["depth", "h1", "h2"]
_EMPTY = hashlib.sha256().hexdigest()
_PREFIX = ("conv_id long, depth int, h1 long, h2 long, p1 long, p2 long, bytes long, before long, "
           "is_end boolean")


def _narrow(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: a digest of role and text, the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))


def _carried(parts: DataFrame, **sums: tuple[Callable, str]) -> DataFrame:
    """Per slice of a conversation that lies in several: what its earlier slices amount to.

    A range partition holds at most two incomplete conversations, so this has no more than
    twice as many rows as there are partitions, and may be broadcast. Null before the first.
    """
    totals = parts.groupBy("conv_id", "slice").agg(*[f(of).alias(name) for name, (f, of) in sums.items()])
    cut = totals.groupBy("conv_id").agg(F.min("slice").alias("low"), F.max("slice").alias("high")).where(
        "low <> high").select("conv_id")
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(F.broadcast(cut), "conv_id").select("conv_id", "slice", *[
        (F.sum if f is F.count else f)(name).over(earlier).alias(f"carried_{name}")
        for name, (f, _) in sums.items()])


def _ranked(narrow: DataFrame) -> DataFrame:
    """Rows with ``place`` from 1 in their conversation, and the slice they lie in.

    Conversations are cut by range, so a very long one lies in several slices, and a slice
    learns from a narrow table how many turns came before it.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    parted = saved(narrow.repartitionByRange(
        F.col("conv_id").asc(), *order, F.monotonically_increasing_id().asc()
    ).withColumn("slice", F.spark_partition_id()), "turns")
    carry = _carried(parted, rows=(F.count, "conv_id"))
    within = Window.partitionBy("conv_id", "slice").orderBy(*order)
    return parted.withColumn("local", F.row_number().over(within)).join(
        F.broadcast(carry), ["conv_id", "slice"], "left"
    ).select("conv_id", "slice", "digest", "bytes", (F.col("local") + _or_zero("carried_rows")).alias("place"))


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, slice, depth, digest, bytes), and (conv_id, length) of all conversations.

    The first turns of a conversation come from the first one of its family.
    """
    ranked = saved(_ranked(_narrow(conversations)), "ranked")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED_TURNS + 1)
    convs = ranked.groupBy("conv_id").agg(F.max("place").alias("n"), F.min("slice").alias("slice")).select(
        "conv_id", "n", "slice", base.alias("base"), share.alias("h"))
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = saved(convs.join(bases, "base", "left").select(
        "conv_id", "slice", "base", "h", F.least("h", _or_zero("base_n")).alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own")), "convs")
    own = ranked.join(convs.drop("slice"), "conv_id").where("place > h").select(
        "conv_id", "slice", (F.col("taken") + F.col("place") - F.col("h")).cast("int").alias("depth"),
        "digest", "bytes")
    first = ranked.where((F.col("place") <= MOST_SHARED_TURNS) & (F.col("conv_id") % FAMILY == 0)).select(
        F.col("conv_id").alias("base"), "place", "digest", "bytes")
    taken = convs.join(first, "base").where("place <= taken").select(
        "conv_id", "slice", F.col("place").cast("int").alias("depth"), "digest", "bytes")
    return taken.unionByName(own), convs.select(
        "conv_id", (F.col("taken") + F.col("own")).cast("int").alias("length"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row per rebuilt conversation and depth from 0: digest, parent's digest, bytes before.

    A digest is the exclusive or of hashes of its turns with their places, 128 bits in two
    columns, so the slices of a long conversation are summed apart.
    """
    turns, lengths = rebuilt(conversations)
    hashed = saved(turns.select(
        "conv_id", "slice", "depth", "bytes", F.xxhash64("depth", "digest").alias("t1"),
        F.xxhash64("digest", F.lit("/"), "depth").alias("t2")), "hashed")
    carry = _carried(hashed, h1=(F.bit_xor, "t1"), h2=(F.bit_xor, "t2"), bytes=(F.sum, "bytes"))
    so_far = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = hashed.select(
        "*", F.bit_xor("t1").over(so_far).alias("x1"), F.bit_xor("t2").over(so_far).alias("x2"),
        F.sum("bytes").over(so_far).alias("local")
    ).join(F.broadcast(carry), ["conv_id", "slice"], "left").select(
        "conv_id", "depth", "bytes", "t1", "t2",
        F.col("x1").bitwiseXOR(_or_zero("carried_h1")).alias("h1"),
        F.col("x2").bitwiseXOR(_or_zero("carried_h2")).alias("h2"),
        (F.col("local") + _or_zero("carried_bytes") - F.col("bytes")).alias("before"))
    rows = summed.join(lengths, "conv_id").select(
        "conv_id", "depth", "h1", "h2", F.col("h1").bitwiseXOR(F.col("t1")).alias("p1"),
        F.col("h2").bitwiseXOR(F.col("t2")).alias("p2"), "bytes", "before",
        (F.col("depth") == F.col("length")).alias("is_end"))
    none = F.lit(0).cast("long")
    roots = lengths.select(
        "conv_id", F.lit(0).alias("depth"), *[none.alias(c) for c in ("h1", "h2", "p1", "p2", "bytes", "before")],
        (F.col("length") == 0).alias("is_end"))
    return saved(rows.sortWithinPartitions("conv_id", "depth").unionByName(roots), "prefixes")


def _cells(h1, h2, bits: int, right_shift, low) -> list:
    """Cell of a digest in each row of the sketch: bits of the digest that don't overlap."""
    return [right_shift(h1, 64 - bits), right_shift(h2, 64 - bits), low(h1, (1 << bits) - 1)]


def sketch(prefix_rows: DataFrame) -> tuple[int, np.ndarray]:
    """Bits per cell number, and a bit per cell of the count-min sketch that counted two or more.

    An estimate is the least count among a prefix's cells, so it is one if any of its bits
    is unset. The sketch grows with the prefixes up to a fixed size; a fuller one screens
    less, and the exact part does more.
    """
    n = prefix_rows.where("depth > 0").count()
    bits = min(max(int(CELLS_PER_PREFIX * n - 1).bit_length(), LEAST_CELL_BITS), MOST_CELL_BITS)
    cells = _cells(F.col("h1"), F.col("h2"), bits, F.shiftrightunsigned, lambda h, m: h.bitwiseAND(F.lit(m).cast("long")))
    numbered = [c + F.lit((r << bits) + 1).cast("long") for r, c in enumerate(cells)]
    counted = prefix_rows.where("depth > 0").select(F.explode(F.array(*numbered)).alias("cell")).groupBy(
        "cell").agg(F.count("*").alias("n")).where("n > 1")
    pages = counted.groupBy(F.bitmap_bucket_number("cell").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).toPandas()
    several = np.zeros(max((SKETCH_ROWS << bits) // 8, 4096), np.uint8)
    for page, content in zip(pages.page, pages.bits, strict=True):
        several[(page - 1) * 4096:page * 4096] = np.frombuffer(content, np.uint8)
    return bits, several


def screened(prefix_rows: DataFrame) -> DataFrame:
    """Prefix rows with ``alone``, proven to be held by one conversation, and ``top``.

    A prefix is alone if its estimate is one or a shorter one of the same conversation is;
    ``top`` is the first such of a conversation. Rows of a conversation lie together; where
    a split of the file cuts them, what follows is only screened by its own estimates.
    """
    bits, several = sketch(prefix_rows)
    shared = prefix_rows.sparkSession.sparkContext.broadcast(several)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cut = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth, h1, h2 = (batch.column(c).to_numpy() for c in ("conv_id", "depth", "h1", "h2"))
            alone = np.zeros(len(conv), bool)
            cells = _cells(h1.view(np.uint64), h2.view(np.uint64), bits,
                           lambda h, s: h >> np.uint64(s), lambda h, m: h & np.uint64(m))
            for row, cell in enumerate(cells):
                cell = cell.astype(np.int64) + (row << bits)
                alone |= (shared.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0
            alone &= depth > 0
            start = np.concatenate(([True], (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1] + 1)))
            begin = np.flatnonzero(start)
            if (conv[0], depth[0] - 1) == last and cut:
                alone[0], start[0] = True, False
            run = np.cumsum(np.concatenate(([True], start[1:]))) - 1
            n_alone = np.cumsum(alone)
            alone = n_alone - (n_alone[begin] - alone[begin])[run] > 0
            before = np.concatenate(([cut and not start[0]], alone[:-1]))
            last, cut = (conv[-1], depth[-1]), bool(alone[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(alone), pa.array(alone & (start | ~before))],
                [*batch.schema.names, "alone", "top"])

    return saved(prefix_rows.mapInArrow(screen, f"{_PREFIX}, alone boolean, top boolean"), "screened")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node's ending conversations, sorted by node and id.

    The ids stream through; a node's run may span batches.
    """
    names = [*_KEY, "ends_sha256"]
    key, digest = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _KEY], 1)
        ids = batch.column("conv_id").cast(pa.string()).to_pylist()
        begin = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))).tolist()
        done = []
        for at, to in zip(begin, [*begin[1:], len(ids)], strict=True):
            own = tuple(keys[at].tolist())
            joined = ",".join(ids[at:to]).encode()
            if own == key:
                digest.update(b"," + joined)
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(joined)
        yield _rows(done, names)
    if key is not None:
        yield _rows([(*key, digest.hexdigest())], names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _parent_key(rows: DataFrame) -> list[Column]:
    return [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")]


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations; columns as the query's contract names them.

    A conversation's turns are ordered by turn, null first; rows of equal turn by the MD5 of
    the code points in the role, a colon, role and text, and repeated rows all count. Null
    roles and texts are empty. Rows without conv_id belong to no conversation and are left
    out. An empty table has no nodes, not even a root. Long texts pass only through MD5.
    """
    small_batches(conversations.sparkSession)
    rows = screened(prefixes(conversations))
    shared, tops = rows.where("not alone"), rows.where("top")
    nodes = saved(shared.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("p1").alias("p1"),
        F.first("p2").alias("p2"), F.first("before").alias("before")), "nodes")
    below = nodes.where("depth > 0").select(*_parent_key(nodes)).unionAll(tops.select(*_parent_key(tops)))
    children = below.groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    nodes = saved(nodes.join(children, _KEY, "left").withColumn("n_children", _or_zero("n_children")), "nodes")

    # where a conversation begins to own its path, and whether it owns a leaf
    owned = nodes.select("conv_id", "depth", "before", (F.col("n_children") == 0).alias("leaf")).unionAll(
        tops.select("conv_id", "depth", "before", F.lit(True))).unionAll(
        shared.where("is_end").select("conv_id", F.col("depth") + 1, F.col("before") + F.col("bytes"), F.lit(False)))
    owners = owned.groupBy("conv_id").agg(
        F.min(F.struct(F.col("depth").alias("owned"), F.col("before").alias("common"))).alias("o"),
        F.max("leaf").alias("leaf")).select("conv_id", "o.*", "leaf")
    sums = shared.join(owners, "conv_id").groupBy(*_KEY).agg(
        F.count_if("leaf").alias("n_leaves"),
        F.sum(F.when(F.col("owned") > F.col("depth"), F.col("common") - F.col("before")).otherwise(0)).alias("saved_tokens"))
    ends = shared.where("is_end").select(*_KEY, "conv_id").repartition(*_KEY).sortWithinPartitions(
        *_KEY, "conv_id").mapInArrow(_ends, "depth int, h1 long, h2 long, ends_sha256 string")
    full = nodes.join(sums, _KEY).join(ends, _KEY, "left").select(
        "conv_id", "depth", "p1", "p2", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
    own_end = F.when(F.col("is_end"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_EMPTY))
    tail = rows.where("alone").select(
        "conv_id", "depth", "p1", "p2", F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("is_end"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        own_end.alias("ends_sha256"), "top")
    found = _with_parent(full.unionAll(tail.where("top").drop("top")), nodes)
    inner = tail.where("not top").withColumn("parent_conv_id", F.col("conv_id"))
    return found.unionByName(inner.select(*found.columns)).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256")


def _with_parent(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add the parent's conversation.

    A parent that was not grouped is alone and belongs to the same conversation. Parents of
    very many children, at most one for each HOT_CHILDREN rows, and the root are broadcast,
    so that no task gets all their children.
    """
    hot = (F.col("n_children") >= HOT_CHILDREN) | (F.col("depth") == 0)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                           F.col("conv_id").alias("theirs"), hot.alias("hot"))
    key = ["depth", "p1", "p2"]
    marked = rows.join(F.broadcast(parents.where("hot").select(*key, F.col("theirs").alias("hot_theirs"))), key, "left")
    settled = (F.col("hot_theirs").isNotNull()) | (F.col("depth") == 0)
    rest = marked.where(~settled).join(parents.where("not hot").drop("hot"), key, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("theirs", "hot_theirs", "conv_id"))
    return marked.where(settled).withColumn("theirs", F.lit(None).cast("long")).unionByName(
        rest).withColumn("parent_conv_id", parent).drop("p1", "p2", "theirs", "hot_theirs")
