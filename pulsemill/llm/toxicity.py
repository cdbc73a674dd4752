"""Toxic documents by marker words.

A few words make a text toxic and don't outweigh the rest in a sum over all n-grams. So
markers are sought: words and word beginnings that labelled toxic documents hold far more
often than labelled clean ones. A document's score is the sum of log(toxic / clean) over
its different marker words. Markers are fitted on one half of the labelled documents,
the least toxic score on the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import words as W
from pulsemill.llm.decontaminate import Members

BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
LEAST_RATIO = 3.5  # of a marker's log(toxic / clean)
LOST_SHARE = 0.005  # clean documents of the second half that may score as toxic
LEAST_DOCS = 3  # toxic documents a marker occurs in, at least
RARE = 200  # and at least one in so many


def features(w: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of words, then of their beginnings of each length, with the places of the words."""
    length = w.end - w.start
    found = [(w.hash, np.arange(len(w.hash)))]
    for n in BEGINNINGS:
        at = np.flatnonzero(length > n)
        total = np.zeros(len(at), np.uint64)
        power = np.multiply.accumulate(np.full(n, W._BASE))
        for i in range(n):
            total += W.ALNUM.value[w.data[w.start[at] + i]] * power[i]
        found.append((W.mix(total ^ np.uint64(n)), at))
    return found


def _document_counts(batches: Iterator[pa.RecordBatch], sought: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """In how many documents each feature, or each of those sought, occurs."""
    members = None if sought is None else Members(sought)
    for batch in batches:
        for part in W.slices(batch, "text"):
            w = W.words(part.column("text"), W.ALNUM)
            hashes, text = [], []
            for h, at in features(w):
                if members:
                    known = members.places(h)
                    h, at = h[known], at[known]
                hashes.append(h)
                text.append(w.text[at])
            h, text = np.concatenate(hashes), np.concatenate(text)
            order = np.lexsort((text, h))
            h, text = h[order], text[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            h, n = np.unique(h[fresh], return_counts=True)
            yield pa.RecordBatch.from_arrays([W.as_long(h), pa.array(n.astype(np.int64))], ["h", "n"])


def markers(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted marker hashes and their log ratios, from rows (text, toxic) of labelled documents.

    Candidates occur in a share of the toxic documents, so their number is bounded; only
    they are counted in the clean ones.
    """
    context = texts.sparkSession.sparkContext
    n = dict(texts.groupBy("toxic").count().collect())
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    least = max(LEAST_DOCS, n_toxic / RARE)
    toxic = (
        texts.where("toxic").select("text").mapInArrow(lambda b: _document_counts(b, None), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy("h").toPandas())
    if not len(toxic):
        return np.zeros(0, np.uint64), np.zeros(0)
    hashes = toxic.h.to_numpy(np.int64).view(np.uint64)
    shared = context.broadcast(hashes)
    clean = (
        texts.where("not toxic").select("text")
        .mapInArrow(lambda b: _document_counts(b, shared.value), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")).toPandas())  # one row per candidate at most
    seen = dict(zip(clean.h, clean.n, strict=True))
    other = np.array([seen.get(h, 0) for h in toxic.h], float)
    ratio = np.log(toxic.n.to_numpy(float) / (n_toxic + 1)) - np.log((other + 1) / (n_clean + 1))
    chosen = ratio > LEAST_RATIO
    order = np.argsort(hashes[chosen])
    return hashes[chosen][order], ratio[chosen][order]


def scores(texts: pa.Array, members: Members, ratio: np.ndarray) -> np.ndarray:
    """Sum over a text's different marker words; a word counts by its strongest feature."""
    w = W.words(texts, W.ALNUM)
    best = np.zeros(len(w.hash))
    if len(ratio):
        for h, at in features(w):
            known = members.places(h)
            at = at[known]
            best[at] = np.maximum(best[at], ratio[np.searchsorted(members.sorted, h[known])])
    marked = np.flatnonzero(best)
    order = marked[np.lexsort((w.hash[marked], w.text[marked]))]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w.hash[order[1:]] != w.hash[order[:-1]]) | (w.text[order[1:]] != w.text[order[:-1]])
    order = order[fresh]
    return np.bincount(w.text[order], best[order], w.n_texts).astype(float)  # of none: integers


def least_score(toxic: np.ndarray, score: np.ndarray) -> float:
    """The least score that at most LOST_SHARE of the clean documents have; infinite without toxic ones."""
    if not toxic.any():
        return math.inf
    clean = np.sort(score[~toxic])
    allowed = math.floor(LOST_SHARE * len(clean))
    floor = clean[len(clean) - 1 - allowed] if len(clean) else 0.0
    return float(np.nextafter(max(floor, LEAST_RATIO), math.inf))
