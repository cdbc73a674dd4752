"""Alignment of two tokenizers over a corpus, counted by external spilling.

Byte offsets where tokens of both end cut them into groups; all pairs of a group are linked.
Every slice of documents writes its pairs as sorted runs, one per radix of the first id. Runs
of a radix are merged through a heap, a bounded number at a time, until one is left: it has
each pair's number of documents, and in side-major order the highest per first id. Then the
slices' records pass those counts once more and leave as sums per document.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import words as W
from pulsemill.llm.common import saved, small_batches
from pulsemill.llm.token_runs import merged, pack, read, run_of, unpack, with_maxima

FOLDER = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
RADIX = 64
FAN_IN = 256
SLICE_BYTES = 2 << 20
CHUNK_CHARS = 1 << 15  # encoded at once
BIG_GROUP = 1 << 16  # links of a group that are counted per id first
REMEMBERED = 300_000  # segments a task keeps
REMEMBERED_CHARS = 8 << 20

# A space is cut before where both tokenizers always end a token: behind a character that is no
# space and before one that is no white space. Elsewhere the text stays in one piece.
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
_UNEVEN = re.compile(r"^ | \s| \Z")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

_ROWS = ("batch long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, radix int, heads binary, bodies binary")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes follow from U+0100.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and what they make of every segment seen lately."""

    def __init__(self, folder: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(f"{folder}/{FIRST}")
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=f"{folder}/{SECOND}")
        of = byte_alphabet()
        vocabulary = sorted((i, token) for token, i in self.first.get_vocab().items())
        self.first_bytes = [
            bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
            for _, token in vocabulary]
        self.second_bytes = [self._piece(i) for i in range(self.second.vocab_size())]
        self.sizes = [np.array([len(x) for x in table]) for table in (self.first_bytes, self.second_bytes)]
        # how ids are written within and at the end of their side of a group
        self.written = [f"{i}{mark}" for table, marks in ((self.first_bytes, ",|"), (self.second_bytes, ",;"))
                        for mark in marks for i in range(len(table))]
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups, self.n_links = (array("q") for _ in range(4))
        self.failed = array("b")
        self.pair_ends = array("q", [0])  # of each segment in the two below
        self.pair, self.times = array("q"), array("q")

    def learn(self, segments: list[str]) -> None:
        """Align segments, each given without the space it begins with.

        Where it starts and ends does not change how a segment is encoded, so many are
        encoded at once, except those with white space at an end.
        """
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        fresh = [s for s in dict.fromkeys(segments) if s not in self.known]
        self.chars += sum(map(len, fresh))
        good, bad = [], []
        for chunk in _chunks(fresh):
            for part in [chunk] if (ids := self._encode(chunk)) else [[s] for s in chunk]:
                found = ids or self._encode(part)
                if found:
                    good.append((part, *found))
                else:
                    bad += part
        if good:
            self._align([s for part, _, _ in good for s in part], *(np.concatenate([g[k] for g in good]) for k in (1, 2)))
        for segment in bad:
            self._add([segment], [""], True, *[np.zeros(1, np.int64)] * 4, *[np.zeros(0, np.int64)] * 3)

    def _encode(self, chunk: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of segments by both tokenizers; None unless both give the bytes back."""
        text = " ".join(chunk)
        want = (" " + text).encode()
        ids = (self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text, num_threads=1))
        if any(b"".join([table[i] for i in own]) != want
               for table, own in zip((self.first_bytes, self.second_bytes), ids, strict=True)):
            return None
        return tuple(np.array(own, np.int64) for own in ids)

    def _align(self, segments: list[str], one: np.ndarray, two: np.ndarray) -> None:
        ends = [np.cumsum(size[own]) for size, own in zip(self.sizes, (one, two), strict=True)]
        common = np.intersect1d(*ends, assume_unique=True)
        segment_ends = np.cumsum([len(s.encode()) + 1 for s in segments])
        if not np.isin(segment_ends, common).all():
            raise ValueError("a vocabulary joins words across a space")
        of = np.searchsorted(segment_ends, common)  # segment of each group
        group = [np.searchsorted(common, e) for e in ends]
        n = [np.bincount(g, minlength=len(common)) for g in group]
        first_two = np.cumsum(n[1]) - n[1]
        sums = [np.bincount(of[g], minlength=len(segments)) for g in group] + [
            np.bincount(of, minlength=len(segments)), np.add.reduceat(n[0] * n[1], np.searchsorted(of, np.arange(len(segments))))]

        last = [np.concatenate((g[1:] != g[:-1], [True])) for g in group]
        codes = np.empty(len(one) + len(two), np.int64)
        codes[np.arange(len(one)) + first_two[group[0]]] = one + last[0] * len(self.first_bytes)
        codes[np.arange(len(two)) + np.cumsum(n[0])[group[1]]] = (
            2 * len(self.first_bytes) + two + last[1] * len(self.second_bytes))
        marks = [self.written[k] for k in codes.tolist()]
        to = np.cumsum(sums[0] + sums[1]).tolist()
        texts = ["".join(marks[x:y])[:-1] for x, y in zip([0, *to[:-1]], to, strict=True)]

        big = n[0] * n[1] > BIG_GROUP
        size = np.where(big, 0, n[1])[group[0]]  # links of each token of the first
        left = np.repeat(np.arange(len(one)), size)
        right = first_two[group[0][left]] + np.arange(len(left)) - np.repeat(np.cumsum(size) - size, size)
        segment, pair, times = [of[group[0][left]]], [one[left] << 32 | two[right]], [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(big):
            (p, x), (q, y) = (np.unique(own[k == g], return_counts=True) for own, k in zip((one, two), group, strict=True))
            pair.append((p[:, None] << 32 | q).ravel())
            times.append((x[:, None] * y).ravel())
            segment.append(np.full(len(pair[-1]), of[g]))
        segment = np.concatenate(segment)
        order = np.argsort(segment, kind="stable")
        self._add(segments, texts, False, *sums, np.bincount(segment, minlength=len(segments)),
                  np.concatenate(pair)[order], np.concatenate(times)[order])

    def _add(self, segments: list[str], texts: list[str], failed: bool, n_a, n_b, n_groups, n_links, n_pairs, pair, times) -> None:
        for segment in segments:
            self.known[segment] = len(self.known)
        self.groups += texts
        self.failed.extend([failed] * len(segments))
        for column, more in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, n_groups), (self.n_links, n_links),
                             (self.pair_ends, self.pair_ends[-1] + np.cumsum(n_pairs if len(n_pairs) else [0])),
                             (self.pair, pair), (self.times, times)):
            column.frombytes(np.ascontiguousarray(more, np.int64).tobytes())


def _chunks(segments: list[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for segment in segments:
        if not segment or segment[0].isspace() or segment[-1] == " ":
            yield [segment]
            continue
        chunk.append(segment)
        size += len(segment)
        if size > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def segments(text: str) -> list[str]:
    return _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")


def _slice_rows(texts: list, known: Aligner) -> tuple[dict[str, np.ndarray], list[str], tuple[np.ndarray, ...]]:
    """Sums and digest of each text, and the linked pairs of all: (pair, text, links), side-major by radix."""
    cut = [segments(t) if t else [] for t in texts]
    flat = [s for parts in cut for s in parts]
    known.learn(flat)
    n = np.array([len(parts) for parts in cut], np.int64)
    index = np.fromiter(map(known.known.__getitem__, flat), np.int64, len(flat))
    of = np.repeat(np.arange(len(texts)), n)
    failed = np.bincount(of, np.frombuffer(known.failed, np.int8)[index], len(texts)) > 0
    sums = {name: np.where(failed, 0, np.bincount(of, np.array(getattr(known, name))[index], len(texts)).astype(np.int64))
            for name in ("n_a", "n_b", "n_groups", "n_links")}
    groups, at, digests = known.groups, 0, []
    places = index.tolist()
    for i, m in enumerate(n.tolist()):
        own = "" if failed[i] or not m else hashlib.sha256(
            ";".join([groups[p] for p in places[at:at + m]]).encode()).hexdigest()
        digests.append(own)
        at += m
    ok = ~failed[of]
    return sums, digests, _records(index[ok], of[ok], len(texts), known)


def _records(index: np.ndarray, of: np.ndarray, n_texts: int, known: Aligner) -> tuple[np.ndarray, ...]:
    once, times = np.unique(of * len(known.groups) + index, return_counts=True)
    text, segment = once // max(len(known.groups), 1), once % max(len(known.groups), 1)
    ends = np.array(known.pair_ends)
    begin, size = ends[segment], ends[segment + 1] - ends[segment]
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    pair, links = np.array(known.pair)[place], np.array(known.times)[place] * np.repeat(times, size)
    distinct, rank = np.unique(pair, return_inverse=True)
    order = np.lexsort((distinct, (distinct >> 32) % RADIX))
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    key = moved[rank] * n_texts + np.repeat(text, size)
    order = np.argsort(key, kind="stable")
    key, links = key[order], links[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat(links, start) if len(start) else links
    key = key[start]
    by_place = np.empty(len(distinct), np.int64)
    by_place[moved] = distinct
    return by_place[key // n_texts], key % n_texts, links


def _spilled(folder: str):
    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Aligner(folder)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                sums, digests, (pair, text, links) = _slice_rows(part.column("text").to_pylist(), known)
                n = part.num_rows
                yield _batch(n, batch=np.full(n, number), row=np.arange(n, dtype=np.int32),
                             doc_id=part.column("doc_id"), **sums, groups_sha256=digests)
                radix = (pair >> 32) % RADIX
                bounds = np.searchsorted(radix, np.arange(RADIX + 1))
                runs = [(r, slice(a, b)) for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
                heads, bodies = [], []
                for _, own in runs:
                    start = np.flatnonzero(np.diff(pair[own], prepend=-1))
                    n_texts = np.diff(np.append(start, own.stop - own.start))
                    heads.append(run_of(pair[own][start], n_texts))
                    bodies.append(pack(text[own], links[own]))
                yield _batch(len(runs), batch=np.full(len(runs), number),
                             radix=np.array([r for r, _ in runs], np.int32), heads=heads, bodies=bodies)
                number += 1

    return spill


def _batch(n: int, **columns) -> pa.RecordBatch:
    """Rows of the common schema; columns that are not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _ROWS.split(", "))])
    return pa.RecordBatch.from_arrays([
        columns[f.name].cast(f.type) if isinstance(columns.get(f.name), pa.Array)
        else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
        for f in schema], schema=schema)


def _merge(last: bool):
    """Merge the runs of each (radix, part), which lie together."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, part), rows in _grouped(batches, "radix", "part"):
            parts = merged([r["heads"] for r in rows])
            columns = list(zip(*(with_maxima(parts) if last else parts), strict=True))
            run = run_of(*[np.concatenate(c) for c in columns])
            yield pa.RecordBatch.from_pydict({
                "radix": pa.array([radix], pa.int32()), "part": pa.array([part], pa.int64()), "heads": pa.array([run], pa.binary())})

    return merge


def _grouped(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[dict]]]:
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[n] for n in names)
            if own != key and rows:
                yield key, rows
                rows = []
            key = own
            rows.append(row)
    if rows:
        yield key, rows


def _parts(n: int):
    """Number a slice's part among ``n``."""
    return F.pmod(F.xxhash64("batch"), F.lit(n))


def pair_counts(runs: DataFrame) -> DataFrame:
    """One run per radix: (radix, heads) with pairs, documents of each, and whether that is its first id's highest.

    Every round merges at most about FAN_IN runs in a task.
    """
    runs = runs.select("radix", "batch", "heads")
    while True:
        most = runs.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        n_parts = -(-most // FAN_IN)
        last = n_parts <= 1
        runs = saved(
            runs.withColumn("part", _parts(max(n_parts, 1))).repartition("radix", "part")
            .sortWithinPartitions("radix", "part").select("radix", "part", "heads")
            .mapInArrow(_merge(last), "radix int, part long, heads binary"), "merged")
        if last:
            return runs.select("radix", "heads")
        runs = runs.withColumnRenamed("part", "batch")


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a part in the order counts of a radix, runs of it, then the documents."""
    best: dict[int, np.ndarray] = {}
    total: dict[int, np.ndarray] = {}
    part, pairs, counts, highest = None, None, None, None
    names = [f.split()[0] for f in _RESULT.split(", ")]
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["part"] != part:
                part, best, total = row["part"], {}, {}
            if row["kind"] == 0:
                pairs, counts, highest = read(row["heads"])
            elif row["kind"] == 1:
                own, n_texts = read(row["heads"])
                text, links = unpack(row["bodies"])
                place = np.repeat(np.searchsorted(pairs, own), n_texts)
                for sums, value in ((best, links * highest[place]), (total, links * counts[place])):
                    _add(sums, row["batch"], text, value)
            else:
                at = row["row"]
                for name, sums in (("n_best", best), ("count_sum", total)):
                    own = sums.get(row["batch"], ())
                    row[name] = int(own[at]) if at < len(own) else 0
                done.append([row[n] for n in names])
        columns = list(zip(*done, strict=True)) or [[]] * len(names)
        kinds = [pa.string() if n == "groups_sha256" else pa.int64() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _add(sums: dict[int, np.ndarray], batch: int, text: np.ndarray, value: np.ndarray) -> None:
    """Add to the sums of a slice's texts."""
    before = sums.get(batch, np.zeros(0, np.int64))
    after = np.zeros(max(len(before), int(text.max()) + 1), np.int64)
    after[:len(before)] = before
    np.add.at(after, text, value)
    sums[batch] = after


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Tokens, groups, links and corpus-wide counts of every document, as the query's contract names them.

    A text that is null or empty, or that either tokenizer does not give back byte by byte
    behind a space, has no tokens: zeros and an empty digest, and it counts for no pair. Every
    row is a document: repeated rows count repeatedly, and a null doc_id stays. Very long texts
    are one slice; a text without spaces is one segment and forgotten soon.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_spilled(folder), _ROWS), "runs")
    runs = rows.where("radix is not null")
    counts = pair_counts(runs)
    slices = runs.select("batch").distinct().count()
    n_parts = max(-(-slices // FAN_IN), min(slices, spark.sparkContext.defaultParallelism), 1)
    numbered = rows.withColumn("part", _parts(n_parts)).withColumn("kind", F.when(F.col("radix").isNull(), 2).otherwise(1))
    known = counts.select("radix", "heads", F.lit(0).alias("kind"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))).alias("part"))
    return (
        numbered.unionByName(known, allowMissingColumns=True).repartition("part")
        .sortWithinPartitions("part", F.col("radix").asc_nulls_last(), "kind")
        .mapInArrow(_contribute, _RESULT))
