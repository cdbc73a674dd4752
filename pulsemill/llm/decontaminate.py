"""Benchmark passages in documents by a prefix-filtered set join.

A benchmark window is the set of its word shingles, and a document holds the window only
if it holds all of them. So with shingles ordered by their frequency in the corpus, the
rarest one is a necessary prefix: only where it occurs can the window occur. Its offset in
the window gives the one possible start (positional bound), the text must have words
enough before and after it (length bound), and what is left is compared word by word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pulsemill.llm import words as W
from pulsemill.llm.common import saved, set_aside, small_batches

WINDOW = 13
SHINGLE = 4
BLOCK_WINDOWS = 50_000  # windows handed to all tasks at once; more are taken in blocks
SHARE = 20  # contaminated: at least one word in so many is hit

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MAP_BITS = 22


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, window): windows of 13 words, or all words of a shorter item.

    Windows of rows without item_id stay: their words count as hit, only no item is named.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, text in zip(
                    batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = _WORD.findall((text or "").encode().lower())
                for i in range(max(len(tokens) - WINDOW, 0) + 1 if tokens else 0):
                    items.append(item)
                    found.append(b" ".join(tokens[i:i + WINDOW]).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(found, pa.string())], ["item", "window"])

    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(windows, "item string, window string").distinct()


def _shingles_of(tokens: list[bytes]) -> tuple[np.ndarray, int]:
    """Shingle hashes of one window in order, and their length in words."""
    size = SHINGLE if len(tokens) >= SHINGLE else 1
    w = W.words(pa.array([b" ".join(tokens).decode()]), W.ALNUM)
    return (W.shingles(w, size)[0] if size > 1 else w.hash), size


class Members:
    """Which of many hashes belong to a small set: a bitmap first, then a search."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(np.asarray(hashes, np.uint64))
        self.map = np.zeros(1 << _MAP_BITS, bool)
        self.map[self.sorted >> np.uint64(64 - _MAP_BITS)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.map[hashes >> np.uint64(64 - _MAP_BITS)])
        at = np.searchsorted(self.sorted, hashes[maybe])
        at[at == len(self.sorted)] = 0
        return maybe[self.sorted[at] == hashes[maybe]]


def _frequencies(docs: DataFrame, hashes: dict[int, np.ndarray]) -> dict[int, int]:
    """How often each shingle of the block occurs in all documents."""
    sought = docs.sparkSession.sparkContext.broadcast(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = {size: Members(h) for size, h in sought.value.items()}
        total = {size: np.zeros(len(m.sorted), np.int64) for size, m in members.items()}
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column("text"), W.ALNUM)
                for size, m in members.items():
                    h = W.shingles(w, size, False)[0] if size > 1 else w.hash
                    found = np.searchsorted(m.sorted, h[m.places(h)])
                    total[size] += np.bincount(found, minlength=len(m.sorted))
        for size, m in members.items():
            seen = total[size] > 0
            yield pa.RecordBatch.from_arrays(
                [W.as_long(m.sorted[seen]), pa.array(total[size][seen])], ["h", "n"])

    counted = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(
        F.sum("n").alias("n"))
    return {r.h & 0xFFFFFFFFFFFFFFFF: r.n for r in counted.collect()}  # at most one per shingle of the block


@dataclass
class Index:
    """One block of windows: by prefix shingle the offset and length of its windows."""

    windows: set[bytes]
    starts: dict[int, dict[int, tuple[tuple[int, int], ...]]]

    @classmethod
    def build(cls, docs: DataFrame, windows: list[str]) -> Index:
        parts = [(x.encode(), *_shingles_of(x.encode().split(b" "))) for x in windows]
        hashes = defaultdict(list)
        for _, h, size in parts:
            hashes[size].append(h)
        often = _frequencies(docs, {k: np.unique(np.concatenate(v)) for k, v in hashes.items()})
        starts: dict = defaultdict(lambda: defaultdict(set))
        for text, h, size in parts:
            rarest = min(range(len(h)), key=lambda i: (often.get(int(h[i]), 0), int(h[i])))
            starts[size][int(h[rarest])].add((rarest, text.count(b" ") + 1))
        return cls(
            {text for text, _, _ in parts},
            {size: {h: tuple(sorted(x)) for h, x in by.items()} for size, by in starts.items()})

    def hits(self, w: W.Words, members: dict[int, Members]) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words lie in a window, and the windows of each text."""
        hit, found = np.zeros(len(w.hash), bool), defaultdict(set)
        bounds = w.bounds()
        for size, m in members.items():
            n = len(w.hash) - size + 1
            if n <= 0:
                continue
            if size > 1:
                h, _ = W.shingles(w, size, False)
                at = np.flatnonzero(w.text[:n] == w.text[size - 1:])
            else:
                h, at = w.hash, np.arange(n)
            for i in m.places(h).tolist():
                place = int(at[i])
                text = int(w.text[place])
                for offset, length in self.starts[size][int(h[i])]:
                    start = place - offset
                    if start < bounds[text] or start + length > bounds[text + 1]:
                        continue
                    words = b" ".join(
                        w.data[a:b].tobytes() for a, b in zip(
                            w.start[start:start + length].tolist(),
                            w.end[start:start + length].tolist(), strict=True)).lower()
                    if words in self.windows:
                        hit[start:start + length] = True
                        found[text].add(words.decode())
        return hit, found


def mark(docs: DataFrame, windows: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Documents with n_words, n_hit and the ``found`` windows; needs column text.

    Every block of windows is one pass over the documents (two with the frequencies).
    Columns of the same names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "n_hit", "found", "runs")
    plain = docs
    distinct = saved(windows.select("window").distinct(), "windows")
    n_blocks = max(1, -(-distinct.count() // block_windows))
    out = docs.withColumn("runs", F.array().cast("array<bigint>")).withColumn(
        "found", F.array().cast("array<string>")).withColumn("n_words", F.lit(0).cast("long"))
    for k in range(n_blocks):
        block = distinct.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k)
        index = Index.build(plain, [r.window for r in block.collect()])
        if k:
            out = saved(out, "marked")
        out = out.mapInArrow(_marker(spark.sparkContext.broadcast(index)), _marked(docs))
    runs = F.aggregate("runs", F.lit(0).cast("long"), lambda a, x: a + F.pmod(x, F.lit(1 << 31)))
    if n_blocks > 1:
        covered = F.array_distinct(F.flatten(F.transform("runs", lambda x: F.sequence(
            F.shiftright(x, 31), F.shiftright(x, 31) + F.pmod(x, F.lit(1 << 31)) - 1))))
        runs = F.size(covered).cast("long")
    return out.withColumn("n_hit", runs).drop("runs")


def _marked(docs: DataFrame) -> StructType:
    return StructType([
        *docs.schema.fields, StructField("runs", ArrayType(LongType())),
        StructField("found", ArrayType(StringType())), StructField("n_words", LongType())])


def _marker(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        members = {size: Members(np.fromiter(by, np.uint64, len(by)))
                   for size, by in index.starts.items()}
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column("text"), W.ALNUM)
                hit, found = index.hits(w, members)
                runs = {i: _runs(hit[a:b]) for i, (a, b) in enumerate(zip(
                    w.bounds()[:-1].tolist(), w.bounds()[1:].tolist(), strict=True)) if i in found}
                columns = {name: part.column(name) for name in part.schema.names}
                if runs:
                    for name, new in (("runs", runs), ("found", found)):
                        old = columns[name].to_pylist()
                        columns[name] = pa.array(
                            [x + sorted(new[i]) if i in new else x for i, x in enumerate(old)],
                            columns[name].type)
                columns["n_words"] = pa.array(w.counts())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _runs(hit: np.ndarray) -> list[int]:
    """Maximal runs of hit words, each as start * 2^31 + length."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(int(a) << 31) + int(b - a) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    return (F.col(n_hit) > 0) & (SHARE * F.col(n_hit) >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and is never contaminated; an item without words has
    no windows. A passage of a row without item_id counts in n_hit and contaminated, but not in
    n_items and the digest, which name items. Repeated documents each get their row,
    repeated items count once. No items: the digest of the empty string.
    """
    windows = saved(benchmark_windows(benchmark), "item_windows")
    marked = mark(docs.select("doc_id", "text"), windows, block_windows).drop("text")
    rows = saved(marked.withColumn("row", F.monotonically_increasing_id()), "marked")
    items = (
        rows.select("row", F.explode("found").alias("window"))
        .join(windows.where("item is not null"), "window").select("row", "item").distinct().groupBy("row")
        .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    )
    return rows.join(items, "row", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they are, columns of any name included."""
    aside = set_aside(docs, "text")
    marked = mark(aside, benchmark_windows(benchmark))
    return marked.where(~contaminated()).select(*aside.columns).toDF(*docs.columns)
