"""Quality classifier by importance resampling.

Two generative models over hashed n-grams: the target model from documents labelled good,
the raw model from all documents. Good is a document of quality that is not toxic. A document's log importance weight is the sum of
log(target / raw) over its n-grams. Adding Gumbel noise and keeping the k largest keys is
sampling k documents without replacement in proportion to their weights. Documents whose
marker words say toxic are not drawn from (see ``toxicity``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import toxicity
from pulsemill.llm import words as W
from pulsemill.llm.common import saved, small_batches
from pulsemill.llm.decontaminate import Members

BUCKETS = 1 << 15
NOISE_SEED = 20_240_501
LABELLED_ROWS = 50_000  # bound of the labelled sample (rows of two numbers)
BINS = 1024

_codes = np.arange(256)
_UPPER = (_codes >= 65) & (_codes <= 90)
_LETTER = _UPPER | ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128)
_DIGIT = (_codes >= 48) & (_codes <= 57)


def ngrams(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram.

    N-grams are words, and runs of one to three word forms. The form of a word is its
    letter case, its last two characters if they are no letters, whether it has digits or
    other marks, its length in steps, and whether it repeats a word shortly before.
    """
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = w.end - w.start

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[w.data])))
        return sums[w.end] - sums[w.start]

    letters, upper, digits = total(_LETTER), total(_UPPER), total(_DIGIT)
    last = w.data[w.end - 1].astype(np.uint64)
    before = w.data[np.maximum(w.end - 2, w.start)].astype(np.uint64)
    last = np.where(_LETTER[last], 0, last)
    before = np.where(_LETTER[before] | (last == 0), 0, before)
    case = np.where(upper == 0, 0, np.where(upper == letters, 2 + (letters > 1), 1))
    marks = np.minimum(length - letters - digits, 3)
    size = np.minimum(np.log2(length).astype(np.int64), 6)
    again = np.zeros(len(w.hash), np.int64)
    for step in (1, 2):
        again[step:] |= ((w.hash[step:] == w.hash[:-step]) & (w.text[step:] == w.text[:-step])) * step
    form = (last << np.uint64(40)) | (before << np.uint64(32)) | (
        ((((case * 4 + marks) * 8 + size) * 4 + again) * 2 + (digits > 0)).astype(np.uint64))
    forms = W.Words(w.n_texts, w.data, w.text, w.start, w.end, W.mix(form + np.uint64(5)))
    parts = [(w.hash, w.text)] + [W.shingles(forms, n, False) for n in (1, 2, 3)]
    salt = W.random_values(len(parts), 13)
    buckets = [(W.mix(h ^ s) % np.uint64(BUCKETS)).astype(np.int64)
               for (h, _), s in zip(parts, salt, strict=True)]
    return np.concatenate(buckets), np.concatenate([t for _, t in parts])


def labelled(labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents (doc_id, good, toxic), those least in hash order.

    A document with several labels is good only if all of them say so, and toxic if any does.
    """
    toxic = F.coalesce(F.max("toxic") > 0, F.lit(False))
    return (
        labels.where("doc_id is not null and (quality is not null or toxic > 0)").groupBy("doc_id")
        .agg((F.coalesce(F.min("quality") > 0, F.lit(False)) & ~toxic).alias("good"), toxic.alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )


def log_ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """log(target / raw) per bucket; both models count all n-grams and are smoothed by one."""
    spark = docs.sparkSession
    good = F.broadcast(sample.where("good").select("doc_id", "good"))  # bounded by LABELLED_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                bucket, text = ngrams(W.words(part.column("text"), W.SPACED))
                raw += np.bincount(bucket, minlength=BUCKETS)
                chosen = part.column("good").fill_null(False).to_numpy(zero_copy_only=False)
                target += np.bincount(bucket[chosen[text]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    counts = (
        docs.select("doc_id", "text").join(good, "doc_id", "left").select("text", "good")
        .mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # one row per bucket at most
    )
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[counts.bucket] += counts.raw
    target[counts.bucket] += counts.target
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weights(
    docs: DataFrame, ratios: np.ndarray, marks: tuple[np.ndarray, np.ndarray], seed: int = NOISE_SEED,
    carried: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Rows (*carried, log_weight, sample_key, toxic_score); a text without words weighs nothing (-inf)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    marked = docs.sparkSession.sparkContext.broadcast(marks)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = Members(marked.value[0])
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column("text"), W.SPACED)
                bucket, text = ngrams(w)
                total = np.bincount(text, shared.value[bucket], part.num_rows).astype(float)
                total[w.counts() == 0] = -np.inf
                noise = part.column("noise").to_numpy()
                key = total - np.log(-np.log(noise))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], pa.array(total), pa.array(key),
                     pa.array(toxicity.scores(part.column("text"), members, marked.value[1]))],
                    [*carried, "log_weight", "sample_key", "toxic_score"])

    # 52 bits of a hash of id and text, halfway between the ends of (0, 1)
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 12) + 0.5) / float(1 << 52)
    schema = docs.select(*carried).schema
    for name in ("log_weight", "sample_key", "toxic_score"):
        schema = schema.add(name, "double")
    return docs.select(*dict.fromkeys([*carried, "text"]), uniform.alias("noise")).mapInArrow(score, schema)


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, exactly; None if there are fewer rows.

    The range that holds it is cut into bins again and again; only counts per bin reach
    the driver, and no row is sorted.
    """
    lo, hi, n = keys.where(F.col(column) > -math.inf).agg(
        F.min(column), F.max(column), F.count("*")).first()
    if k < 1 or n < k:
        return None
    rest = k
    while lo < hi:
        step = (hi - lo) / BINS
        if step == 0 or lo + step == lo:
            values = keys.where(F.col(column).between(lo, hi)).groupBy(column).count().collect()
            for value, count in sorted(values, reverse=True):
                rest -= count
                if rest <= 0:
                    return value
        slot = F.least(F.floor((F.col(column) - lo) / step), F.lit(BINS - 1))
        bins = keys.where(F.col(column).between(lo, hi)).groupBy(slot.alias("slot")).agg(
            F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for b in sorted(bins, key=lambda b: -b.slot):
            if rest <= b.n:
                lo, hi = b.lo, b.hi
                break
            rest -= b.n
    return lo


def quality_sample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = NOISE_SEED,
    carried: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Rows (*carried, log_weight, sample_key, selected), one per document.

    ``share`` of the documents is selected, by default the share of good ones among the
    labelled. A null or empty text has no n-grams and is never selected, nor is one whose
    words say toxic, as far as labels tell it from clean ones. Repeated rows have
    one key and are selected or rejected together, so ties at the end may add rows. Without
    any label all documents with words are selected. ``carried`` names columns of the
    documents that travel along, by default the id; with all of them the sample is a filter
    that needs no join.
    """
    small_batches(docs.sparkSession)
    sample = saved(labelled(labels), "labelled")
    n_good, n_labelled = sample.agg(
        F.coalesce(F.sum(F.col("good").cast("int")), F.lit(0)), F.count("*")).first()
    if share is None:
        share = n_good / n_labelled if n_labelled else 1.0
    first = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    fitted, tried = (F.broadcast(sample.where(x).select("doc_id", "toxic")) for x in (first, ~first))
    marks = toxicity.markers(docs.select("doc_id", "text").join(fitted, "doc_id").select("text", "toxic"))
    scored = saved(weights(docs, log_ratios(docs, sample), marks, seed, carried), "scored")
    trial = scored.join(tried, "doc_id").groupBy("doc_id", "toxic").agg(
        F.max("toxic_score").alias("score")).toPandas()  # bounded by LABELLED_ROWS
    bound = toxicity.least_score(trial.toxic.to_numpy(bool), trial.score.to_numpy(float))
    clean = F.col("toxic_score") < bound
    k = math.ceil(share * scored.count())
    least = kth_largest(scored.where(clean), "sample_key", k)
    least = -math.inf if least is None else least
    chosen = (F.col("sample_key") >= least) & (F.col("log_weight") > -math.inf) & clean
    return scored.withColumn("selected", chosen if k else F.lit(False)).drop("toxic_score")
