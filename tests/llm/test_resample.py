import math
from collections import Counter

import pyarrow as pa
import pytest

from pulsemill.llm import resample as R
from pulsemill.llm import words as W
from tests.llm.data import frame, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rows = [(i, prose(60, i) + ".", "en", "s", 0) for i in range(300)]
    junk = [(300 + i, " ".join(w.upper() + "!!" for w in prose(40, 500 + i).split()), "en", "s", 0) for i in range(60)]
    labels = [(i, 1, 0) for i in range(0, 300, 2)] + [(300 + i, 0, 0) for i in range(0, 60, 2)]
    return rows + junk, labels


def test_clean_stay_and_junk_goes(spark):
    rows, labels = corpus()
    result = R.quality_sample(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    kept = {r.doc_id for r in result if r.selected}
    assert len(result) == 360 and len(kept) == 300  # the labelled share
    assert len(kept & set(range(300))) >= 297


def test_selection_is_the_top_k(spark):
    rows, labels = corpus()
    result = R.quality_sample(frame(spark, rows), spark.createDataFrame(labels, LABELS), share=0.25).collect()
    ordered = sorted((r.sample_key for r in result), reverse=True)
    assert {r.sample_key for r in result if r.selected} == set(ordered[:90])


def test_weights_against_plain_counts(spark):
    """The log ratio of every document from counters over all n-grams, summed one by one."""
    rows, labels = corpus()
    rows = rows[::4] + [(900, None, "en", "s", 0), (901, "", "en", "s", 0)]
    good = {i for i, quality, _ in labels if quality}
    grams = {i: R.ngrams(W.words(pa.array([text], pa.string()), W.SPACED))[0].tolist() for i, text, *_ in rows}
    raw, target = Counter(), Counter()
    for i, own in grams.items():
        raw.update(own)
        target.update(own if i in good else ())
    all_raw, all_target = raw.total() + R.BUCKETS, target.total() + R.BUCKETS
    result = R.quality_sample(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(result) == len(rows)
    for r in result:
        own = [math.log((target[b] + 1) / all_target) - math.log((raw[b] + 1) / all_raw) for b in grams[r.doc_id]]
        assert r.log_weight == (pytest.approx(sum(own), abs=1e-8) if own else -math.inf)


def test_awkward_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, 1, None), (None, 1, 0), (6, None, 0)], LABELS)
    result = R.quality_sample(frame(spark), labels, share=1.0).collect()
    assert len(result) == 20
    empty = [r for r in result if r.log_weight == -math.inf]
    assert len(empty) == 4 and not any(r.selected for r in empty)
    assert sum(r.selected for r in result) == 16
    twice = [r.sample_key for r in result if r.doc_id == 11]
    assert twice[0] == twice[1]


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABELS)
    assert R.quality_sample(frame(spark, []), none).count() == 0
    assert R.quality_sample(frame(spark), none).where("selected").count() == 16


def test_kth_largest(spark):
    values = [1.0, 1.0, 2.5, -3.0, 1e300, -1e300, 7.0, 7.0, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k, expected in enumerate(sorted(values, reverse=True), 1):
        assert R.kth_largest(df, "x", k) == expected
    assert R.kth_largest(df, "x", 10) is None


def test_toxic_documents_are_caught(spark):
    """A few words in an otherwise good text; half of the documents have no label."""
    insults = "vilest grubbish snarlow meanly foulard".split()
    rows, labels = [], []
    for i in range(400):
        words = prose(80, 1000 + i).split()
        toxic = i % 5 == 0
        if toxic:
            for n in range(3):
                words.insert(20 * n + i % 7, insults[(i // 5 + n) % 5])
        rows.append((i, " ".join(words) + ".", "en", "s", 0))
        if i // 5 % 2:
            labels.append((i, 1, int(toxic)))
    result = R.quality_sample(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    kept = {r.doc_id for r in result if r.selected}
    assert len(result) == 400 and not [i for i in kept if i % 5 == 0]
    assert len(kept) >= 0.95 * 320


def test_labelled(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (5, None, 1), (6, None, 0), (7, 1, 0), (7, 1, 1)], LABELS)
    found = {r.doc_id: (r.good, r.toxic) for r in R.labelled(labels).collect()}
    assert found == {1: (True, False), 2: (False, True), 3: (False, False), 4: (True, False), 5: (False, True),
                     7: (False, True)}
