"""Near-duplicate classes by ProbMinHash sketches, banding and exact verification.

A document's five-word shingles, weighted from 1 for a single one towards MOST_WEIGHT for
one that is repeated, are Poisson processes over the registers of a sketch: a shingle of
weight w arrives with rate w, its i-th
arrival goes to the i-th register of its own permutation, and each register keeps the
earliest arrival. Arrivals later than the latest register change nothing, so a shingle
stops there. Two sketches agree in a register with the probability Jaccard similarity.
Links are decided on sets, so weights are kept within a narrow range: texts that differ
in how often they repeat a line must still propose each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from pulsemill.llm import words as W
from pulsemill.llm.common import saved, small_batches
from pulsemill.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
REGISTERS = 128
ROWS = 5
BANDS = REGISTERS // ROWS
MOST_WEIGHT = 1.5
MAP_WORDS = 16  # longs of a set's bitmap
RARITY_BITS = 17  # size of the table that orders shingles by how frequent they are

_ID = np.uint64(0xFFFFFFFF)
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def weighted(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text and their weights; needs texts in ascending order.

    Text number and shingle are sorted as one integer: 20 bits are enough for the texts
    of a slice, 44 for the shingles of one text among each other.
    """
    if len(text) and text[-1] >= 1 << 20:
        raise ValueError("slice the batch first")
    packed = (text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    packed.sort()
    first = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1]))) if len(packed) else (
        np.zeros(0, np.int64))
    count = np.diff(np.append(first, len(packed)))
    keys = packed[first]
    return keys & np.uint64((1 << 44) - 1), (keys >> np.uint64(44)).astype(np.int64), MOST_WEIGHT - (MOST_WEIGHT - 1) / count


def sketches(
    keys: np.ndarray, text: np.ndarray, weight: np.ndarray, n_texts: int
) -> np.ndarray:
    """Per text and register the id of the earliest shingle; unset for a text without one."""
    m = REGISTERS
    seed = W.mix(keys * np.uint64(2) + np.uint64(1))
    ids = seed & _ID
    shift = (W.mix(seed + np.uint64(1)) & np.uint64(m - 1)).astype(np.int64)
    stride = (W.mix(seed + np.uint64(2)) & np.uint64(m - 1)).astype(np.int64) | 1
    registers = np.full(n_texts * m, _UNSET)
    latest = np.full(n_texts, np.inf)
    time = np.zeros(len(keys))
    alive = np.arange(len(keys))
    for i in range(m):
        draw = W.mix(seed[alive] ^ W.random_values(m, 3)[i])
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        # i registers of this shingle are taken: the rest is hit at the rate of what is left
        time[alive] -= np.log(uniform) / (weight[alive] * (1 - i / m))
        alive = alive[time[alive] < latest[text[alive]]]
        if not len(alive):
            break
        slot = text[alive] * m + ((shift[alive] + stride[alive] * i) & (m - 1))
        arrival = time[alive].astype(np.float32).view(np.uint32).astype(np.uint64)
        np.minimum.at(registers, slot, (arrival << np.uint64(32)) | ids[alive])
        worst = registers.reshape(n_texts, m).max(1)
        filled = worst != _UNSET
        latest[filled] = (worst[filled] >> np.uint64(32)).astype(np.uint32).view(np.float32)
    return registers.reshape(n_texts, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band of registers."""
    ids = (registers & _ID)[:, :BANDS * ROWS].reshape(len(registers), BANDS, ROWS)
    power = np.multiply.accumulate(np.full(ROWS, W._STEP))
    salt = W.random_values(BANDS, 11)
    return W.mix((ids * power).sum(2, dtype=np.uint64) + salt)


def _digests(w: W.Words) -> pa.Array:
    """128-bit digest of each text's word sequence, null without words."""
    bounds, raw = w.bounds().tolist(), memoryview(np.ascontiguousarray(w.hash)).cast("B")
    return pa.array([
        hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ], pa.binary())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            w = W.words(part.column("text"), W.ALNUM)
            keys, text, weight = weighted(*W.shingles(w, WORDS))
            bands = band_keys(sketches(keys, text, weight, part.num_rows))
            rows = np.arange(part.num_rows + 1, dtype=np.int32)
            named = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([
                *[part.column(c) for c in named], _digests(w),
                pa.array(np.bincount(text, minlength=part.num_rows)),
                pa.ListArray.from_arrays(pa.array(rows * BANDS), W.as_long(bands.ravel())),
            ], [*named, "node", "n_shingles", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            w = W.words(part.column("text"), W.ALNUM)
            keys, text, _ = weighted(*W.shingles(w, WORDS))
            ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=part.num_rows))))
            yield pa.RecordBatch.from_arrays([
                part.column("node"), pc.equal(part.column("node"), _digests(w)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), W.as_long(keys)),
            ], ["node", "own", "shingles"])


def _all_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts whose node is not known yet."""
    def with_node():
        for batch in batches:
            for part in W.slices(batch, "text"):
                node = _digests(W.words(part.column("text"), W.ALNUM))
                yield pa.RecordBatch.from_arrays([node, part.column("text")], ["node", "text"])

    return _sets(with_node())


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (W.mix(shingles) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a batch of sets, and how many each set has."""
    sets = batch.column("shingles")
    return sets.flatten().to_numpy().view(np.uint64), np.diff(sets.offsets.to_numpy())


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How often shingles of each table slot occur; slots are shared, the table is bounded."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            total += np.bincount(_slot(_flat(batch)[0]), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    rows = sets.select("shingles").mapInArrow(count, "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << RARITY_BITS, np.int64)
    total[rows.slot] = rows.n
    return total


def _bitmaps(flat: np.ndarray, of: np.ndarray, n_sets: int) -> pa.Array:
    """Each bit of a set's map is the parity of the shingles that fall on it."""
    bit = W.mix(flat ^ W.random_values(1, 17)[0]) & np.uint64(64 * MAP_WORDS - 1)
    maps = np.zeros(n_sets * MAP_WORDS, np.uint64)
    np.bitwise_xor.at(
        maps, of * MAP_WORDS + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return W.as_long(maps)


def _prefixes(sets: DataFrame) -> DataFrame:
    """Rows (node, n_shingles, prefix, bits): rarest shingles and parity bitmap of each set.

    Two sets of similarity s share one of the first n - ceil(s * n) + 1 shingles of either
    in any one order of all shingles. With the rarest first, a passage that many documents
    quote brings only those together that have little else.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_frequencies(sets))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, n = _flat(batch)
            of = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((flat, shared.value[_slot(flat)], of))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            least = np.ceil(SIMILARITY * n - 1e-9).astype(np.int64)
            size = n - least + 1
            first = flat[order[place < np.repeat(size, n)]]
            ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array(n.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), W.as_long(first)),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1, dtype=np.int32) * MAP_WORDS), _bitmaps(flat, of, len(n))),
            ], ["node", "n_shingles", "prefix", "bits"])

    return sets.select("node", "shingles").mapInArrow(
        prefixes, "node binary, n_shingles long, prefix array<long>, bits array<long>")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of bucket members with the least member, if sizes allow the similarity."""
    chosen = members.groupBy("bucket").agg(
        F.min(F.struct("node", "component", "n_shingles")).alias("c")
    ).select(
        "bucket", F.col("c.node").alias("centre"), F.col("c.component").alias("its"),
        F.col("c.n_shingles").alias("its_n"))
    alike = F.least("n_shingles", "its_n") >= SIMILARITY * F.greatest("n_shingles", "its_n")
    return members.join(chosen, "bucket").where((F.col("component") != F.col("its")) & alike).select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _unlike_pairs(members: DataFrame) -> DataFrame:
    """Pairs of bucket members in different components that may be similar enough.

    Sets of similarity s differ in at most (1 - s) / (1 + s) of both sizes' sum, and at
    least in as many shingles as their parity maps differ in bits. So the condition loses
    no pair, and what it lets through is nearly similar: a family of texts that differ too
    much never becomes rows.
    """
    other = members.select("bucket", *[F.col(c).alias(f"its_{c}") for c in members.columns if c != "bucket"])
    n, m = F.col("n_shingles"), F.col("its_n_shingles")
    differing = sum(
        (F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("its_bits", F.lit(i)))) for i in range(MAP_WORDS)),
        F.lit(0))
    return members.join(other, "bucket").where(
        (F.col("node") < F.col("its_node")) & (F.col("component") != F.col("its_component"))
        & (F.least(n, m) >= SIMILARITY * F.greatest(n, m))
        & (differing * (1 + SIMILARITY) <= (1 - SIMILARITY) * (n + m) + 1e-6)
    ).select(F.col("node").alias("a"), F.col("its_node").alias("b")).distinct()


def _several(members: DataFrame, least: int) -> DataFrame:
    """Buckets of at least so many members in more than one component."""
    return members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where((F.col("low") != F.col("high")) & (F.col("n") >= least)).select("bucket")


def _unsettled(members: DataFrame) -> DataFrame:
    return saved(members.join(_several(members, 2), "bucket"), "unsettled")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    return members.drop("component").join(components(links), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of documents and the verified links between different texts.

    Classes: one row per document (doc_id, class_id, representative, n_shingles). Words
    are runs of ASCII letters, digits and characters beyond ASCII, lower-cased in A-Z.
    Documents with equal word sequences share a representative, the least doc_id among
    them; classes are the connected components over Jaccard similarities of at least
    SIMILARITY between sets of five-word shingles, named by their least doc_id. A text
    of fewer words is one shingle. A null text, or one without words, is alike to nothing:
    its class is its own doc_id. Repeated rows stay and share their class. A null doc_id
    gets the class of its text, null if no member has an id. Links: (a, b, similarity) by
    word-sequence digest.

    Only equal sketch bands propose pairs. First all members of a bucket are held against
    its least member: a group of copies becomes one component, so its pairs are never
    listed. What a star can miss are links between members in different components. The
    members of buckets that still hold several components are therefore joined once more,
    exactly, by shared prefixes of their shingle sets: again stars first, then all pairs of
    different components.
    """
    classes, links = _classes(docs)
    return classes.select("doc_id", "class_id", "representative", "n_shingles"), links


def one_of_each(docs: DataFrame, row_key: str) -> DataFrame:
    """Rows (row_key, n): a row of each class, how many rows have its key.

    The row with the least doc_id is named, among equal ids that with the least key, one
    without id only in a class without ids. Rows without words are alike to nothing but rows
    of their own key. Two narrow aggregates; a class of any size combines before the shuffle.
    """
    rows, _ = _classes(docs, row_key)
    group = F.coalesce("component", F.col(row_key).cast("binary")).alias("group")
    keys = rows.groupBy(group, row_key).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row_key, "n"))
    return keys.groupBy("group").agg(least.alias("least")).select(f"least.{row_key}", "least.n")


def _classes(docs: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """What ``near_duplicates`` returns, with ``component`` and carried columns; no component without words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("doc_id", "text")
    schema = docs.select("doc_id", *carried).schema
    for name, kind in (("node", "binary"), ("n_shingles", "long"), ("bands", ArrayType(LongType()))):
        schema = schema.add(name, kind)
    sketched = saved(docs.select("doc_id", "text", *carried).mapInArrow(_sketch, schema), "sketches")
    nodes = sketched.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("representative"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"))
    buckets = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(
        buckets.join(shared.select("bucket"), "bucket").withColumn("component", F.col("node")), "members")
    sets = _shingle_sets(texts, sketched, members)

    pairs = saved(_stars(members), "pairs")
    links = saved(_verified(pairs, sets), "links")
    members = _labelled(members, links)
    open_nodes = saved(members.join(_several(members, 3), "bucket").select("node").distinct(), "open")
    if not open_nodes.isEmpty():
        prefixed = saved(_prefixes(sets.join(open_nodes, "node", "left_semi")), "prefixes")
        members = prefixed.select("node", "n_shingles", "bits", F.explode("prefix").alias("bucket"))
        members = _unsettled(_labelled(members, links))
        again = saved(_stars(members).join(pairs, ["a", "b"], "left_anti"), "pairs")
        links = links.union(saved(_verified(again, sets), "links"))
        members = _unsettled(_labelled(members, links))
        rest = saved(_unlike_pairs(members), "pairs")
        links = links.union(saved(_verified(rest, sets), "links"))

    groups = components(links)
    joined = sketched.select("doc_id", *carried, "node", "n_shingles").join(groups, "node", "left").select(
        "doc_id", *carried, "node", "n_shingles", F.coalesce("component", "node").alias("component"))
    joined = saved(joined, "joined")
    least = joined.where("node is not null").groupBy("component").agg(
        F.min("doc_id").alias("class_id"))
    classes = joined.join(least, "component", "left").join(
        nodes.select("node", "representative"), "node", "left")
    own = F.col("node").isNull()
    return classes.select(
        "doc_id", *carried, "component",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("representative")).alias("representative"),
        "n_shingles",
    ), links


def _shingle_sets(texts: DataFrame, sketched: DataFrame, members: DataFrame) -> DataFrame:
    """Shingle set of each node that shares a bucket, from one document of the node.

    A repeated doc_id may bring other texts along; only those of the node's digest count.
    """
    wanted = members.select("node").distinct()
    one = sketched.join(wanted, "node", "left_semi").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"))
    schema = "node binary, own boolean, shingles array<long>"
    named = texts.join(one.where("doc_id is not null"), "doc_id").select("node", "text")
    sets = named.mapInArrow(_sets, schema).where("own")
    nameless = one.where("doc_id is null")
    if not nameless.isEmpty():
        other = texts.where("doc_id is null").select(F.lit(b"").alias("node"), "text")
        digests = other.mapInArrow(_all_sets, schema)
        sets = sets.union(digests.join(nameless, "node", "left_semi").select(sets.columns))
    return saved(sets.dropDuplicates(["node"]).drop("own"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    small, large = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b").where(small >= SIMILARITY * large)
        .withColumn("common", common)
        .withColumn("similarity", F.col("common") / (F.size("x") + F.size("y") - F.col("common")))
        .where(F.col("similarity") >= SIMILARITY).select("a", "b", "similarity")
    )
