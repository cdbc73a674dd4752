"""Quality rules: counts over words and lines, and a line labeller.

A linear-chain conditional random field over a document's lines marks each as content or
boilerplate; the best labelling is found by the Viterbi recursion, and the share of words
in content lines decides whether the document stays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import words as W
from pulsemill.llm.common import small_batches

LEAST_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
CONTENT_SHARE = 0.5
SAMPLE_DOCS = 3_000  # bound of the labelled sample that the field is fitted on
SAMPLE_LINES = 64  # a longer document gives the fit a run of so many lines, from a place its hash names
STEPS = 120

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:!?\"')("

_codes = np.arange(256)
_UPPER = (_codes >= 65) & (_codes <= 90)
_LETTER = _UPPER | ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128)
_DIGIT = (_codes >= 48) & (_codes <= 57)


def _one_of(chars: bytes) -> np.ndarray:
    return np.isin(_codes, list(chars))


CLASSES = np.stack([
    _LETTER, _UPPER, _DIGIT, _one_of(_SYMBOLS), _one_of(b"!"), _one_of(b"|"), _one_of(_STOPS),
    _one_of(b".!?"),
])
N_FEATURES = 14


@dataclass
class Lines:
    """Lines with a word, in order: their text, words and features."""

    text: np.ndarray
    n_words: np.ndarray
    features: np.ndarray


def _between(table: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(table[data])))
    return sums[end] - sums[start]


def lines(w: W.Words, offsets: np.ndarray) -> Lines:
    """Lines of a batch whose words are given; ``offsets`` are the texts' ends in bytes."""
    data = w.data
    cut = np.zeros(len(data) + 1, bool)
    cut[np.flatnonzero(data == 10) + 1] = True
    cut[offsets] = True
    line_start = np.flatnonzero(cut[:-1]) if len(data) else np.zeros(0, np.int64)
    of = np.searchsorted(line_start, w.start, "right") - 1
    used, first, n = np.unique(of, return_index=True, return_counts=True)
    if not len(used):
        return Lines(np.zeros(0, np.int64), n, np.zeros((0, N_FEATURES)))
    start, end = w.start[first], w.end[first + n - 1]
    letter, upper, digit, symbol, shout, bar, stop, final = (
        _between(table, data, start, end).astype(float) for table in CLASSES)
    text = w.text[first]
    size = (end - start).astype(float)

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(float), first)

    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    head = per_line(_LETTER[data[w.start]])
    long = per_line((w.end - w.start) > 20)
    repeated = np.zeros(len(text))
    whole = W.mix(np.add.reduceat(w.hash, first) ^ W.mix(text.astype(np.uint64)))
    order = np.argsort(whole, kind="stable")
    repeated[order[1:]] = whole[order[1:]] == whole[order[:-1]]
    features = np.column_stack([
        np.ones(len(text)), np.log2(n), letter / size, upper / np.maximum(letter, 1), digit / size,
        symbol / n, shout / n, bar / n, stop / n, per_line(same) / n, head / n, long / n,
        _between(CLASSES[7], data, end - 1, end), repeated,
    ]).astype(float)
    return Lines(text, n, features)


@dataclass
class Field:
    """Weights of the field: features by label, transitions, and the features' scale."""

    emit: np.ndarray
    move: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.emit

    @classmethod
    def neutral(cls) -> Field:
        """Calls every line content: for a table without both kinds of labels."""
        emit = np.zeros((N_FEATURES, 2))
        emit[0, 1] = 1.0
        return cls(emit, np.zeros((2, 2)), np.zeros(N_FEATURES), np.ones(N_FEATURES))

    @classmethod
    def fitted(cls, sequences: list[np.ndarray], labels: list[int], steps: int = STEPS) -> Field:
        """Maximum likelihood by gradient ascent, each line labelled as its document."""
        if len(set(labels)) < 2:
            return cls.neutral()
        sequences, labels = zip(*sorted(
            zip(sequences, labels, strict=True), key=lambda x: -len(x[0])), strict=True)
        stacked = np.concatenate(sequences)
        mean, scale = stacked.mean(0), stacked.std(0) + 1e-6
        mean[0], scale[0] = 0.0, 1.0
        length = np.array([len(x) for x in sequences])
        y = np.array(labels)
        x = np.zeros((len(sequences), int(length.max()), N_FEATURES))
        for i, s in enumerate(sequences):
            x[i, :len(s)] = (s - mean) / scale
        weight = np.full(len(y), 1 / length.mean())
        field = cls(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), mean, scale)
        speed_e, speed_m = np.zeros_like(field.emit), np.zeros_like(field.move)
        sizes = [int((length > t).sum()) for t in range(int(length.max()))]
        for _ in range(steps):
            grad_e, grad_m = field._gradient(x, y, weight, sizes)
            grad_e = grad_e / len(y) - 1e-3 * field.emit
            grad_m = grad_m / len(y) - 1e-3 * field.move
            speed_e = 0.9 * speed_e + grad_e
            speed_m = 0.9 * speed_m + grad_m
            field.emit += 0.05 * speed_e
            field.move += 0.05 * speed_m
        return field

    def _gradient(self, x, y, weight, sizes):
        """Observed minus expected features, by the forward-backward recursions."""
        score = x @ self.emit
        steps = len(sizes)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, steps):
            k = sizes[t]
            ahead[:k, t] = np.logaddexp.reduce(ahead[:k, t - 1, :, None] + self.move, axis=1) + score[:k, t]
        for t in range(steps - 2, -1, -1):
            k = sizes[t + 1]
            back[:k, t] = np.logaddexp.reduce(
                self.move + (score[:k, t + 1] + back[:k, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead[:, 0] + back[:, 0], axis=1)
        grad_e, grad_m = np.zeros_like(self.emit), np.zeros_like(self.move)
        own = np.eye(2)[y]
        for t in range(steps):
            k = sizes[t]
            expected = np.exp(ahead[:k, t] + back[:k, t] - total[:k, None])
            grad_e += x[:k, t].T @ ((own[:k] - expected) * weight[:k, None])
            if t + 1 < steps:
                k = sizes[t + 1]
                pair = np.exp(
                    ahead[:k, t, :, None] + self.move + (score[:k, t + 1] + back[:k, t + 1])[:, None, :]
                    - total[:k, None, None])
                grad_m += ((own[:k, :, None] * own[:k, None, :] - pair) * weight[:k, None, None]).sum(0)
        return grad_e, grad_m

    def viterbi(self, features: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Best label of each line; all texts advance together, line by line."""
        if not len(text):
            return np.zeros(0, np.int64)
        score = self.scores(features)
        first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        length = np.diff(np.append(first, len(text)))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        active = np.searchsorted(-length, -np.arange(int(length[0])), "left")
        best = score[first].copy()
        origin = np.zeros((len(text), 2), np.int8)
        for t in range(1, int(length[0])):
            at = first[:active[t]] + t
            ways = best[:active[t], :, None] + self.move
            origin[at] = ways.argmax(1)
            best[:active[t]] = ways.max(1) + score[at]
        labels = np.zeros(len(text), np.int64)
        labels[first + length - 1] = best.argmax(1)
        for t in range(int(length[0]) - 1, 0, -1):
            at = first[:active[t]] + t
            labels[at - 1] = origin[at, labels[at]]
        return labels


def _offsets(part: pa.RecordBatch) -> np.ndarray:
    return W.utf8(part.column("text"))[0]


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """The field fitted on at most ``sample_docs`` labelled documents, least in hash order.

    Each gives all its lines, or SAMPLE_LINES of them in a row, so the sample is bounded
    however long the texts are.
    """
    sample = F.broadcast(
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
        .agg((F.min("quality") > 0).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                offsets, data = W.utf8(part.column("text"))
                found = lines(W.words(part.column("text"), W.SPACED), offsets)
                count = np.bincount(found.text, minlength=part.num_rows)
                first = np.concatenate(([0], np.cumsum(count)))
                fit_for = np.flatnonzero(count > 0)
                for i in np.flatnonzero(count > SAMPLE_LINES):
                    first[i] += zlib.crc32(data[offsets[i]:offsets[i + 1]]) % (count[i] - SAMPLE_LINES + 1)
                taken = np.minimum(count, SAMPLE_LINES)
                yield pa.RecordBatch.from_arrays([
                    part.column("good").take(pa.array(fit_for)),
                    pa.array([found.features[first[i]:first[i] + taken[i]].ravel().tolist() for i in fit_for],
                             pa.list_(pa.float64())),
                ], ["good", "features"])

    rows = (
        docs.select("doc_id", "text").join(sample, "doc_id").select("good", "text")
        .mapInArrow(featured, "good int, features array<double>").toPandas())
    rows = rows.assign(order=[hash(tuple(x)) for x in rows.features]).sort_values("order", kind="stable")
    return Field.fitted(
        [np.reshape(x, (-1, N_FEATURES)) for x in rows.features], rows.good.tolist())


def _repeat_words(w: W.Words) -> np.ndarray:
    """Words of each text that lie in a run of five words that the text has twice or more."""
    n = len(w.hash) - REPEAT_WINDOW + 1
    if n <= 0:
        return np.zeros(w.n_texts, np.int64)
    at = np.flatnonzero(w.text[:n] == w.text[REPEAT_WINDOW - 1:])
    hashes, text = W.shingles(w, REPEAT_WINDOW, False)
    own = W.mix(hashes ^ W.mix(text.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(own)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(w.hash) + 1, np.int64)
    if len(twice):
        place = np.searchsorted(twice, own)
        place[place == len(twice)] = 0
        hit = at[twice[place] == own]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + REPEAT_WINDOW, -1)
    return np.bincount(w.text[np.cumsum(covered[:-1]) > 0], minlength=w.n_texts)


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    seen, again = set(), 0
    for line in text.encode().split(b"\n"):
        if line in seen:
            again += bool(line.strip(_SPACE))
        else:
            seen.add(line)
    return again


_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _rules(field) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = field.value
        starts_char = (_codes & 0xC0) != 0x80
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = part.column("text")
                w = W.words(texts, W.SPACED)
                offsets = _offsets(part)

                def total(table, data=w.data, offsets=offsets):
                    return _between(table, data, offsets[:-1], offsets[1:])

                found = lines(w, offsets)
                label = model.viterbi(found.features, found.text)
                content = np.bincount(found.text, found.n_words * label, part.num_rows)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(w.counts()),
                    pa.array(total(starts_char & W.SPACED.inside)), pa.array(total(CLASSES[3])),
                    pa.array([_dup_lines(x) for x in texts.to_pylist()], pa.int64()),
                    pa.array(_repeat_words(w)), pa.array(content.astype(np.int64)),
                ], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "content_words"])

    return run


def line_quality(
    docs: DataFrame, field: Field, content_share: float = CONTENT_SHARE
) -> DataFrame:
    """Per document the base counts, base_failed, content_words, content_share and kept.

    Words are runs between ASCII white space, lines end at \\n. A null or empty text counts
    0 everywhere, fails the base rule and has share 0. Lines without a word are not
    labelled. Repeated rows each get their row; other columns are left out.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    counted = docs.select("doc_id", "text").mapInArrow(
        _rules(shared), f"doc_id long, {_COUNTS}, content_words long")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("content_words") / F.col("n_words")).otherwise(0.0)
    return counted.withColumn("base_failed", failed).withColumn("content_share", share).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= content_share))
