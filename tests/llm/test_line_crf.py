import itertools

import numpy as np
import pyarrow as pa
import pytest

from pulsemill.llm import line_crf as L
from pulsemill.llm import words as W
from tests.llm.data import documents, frame, prose, spaced


def brute(doc_id, text):
    w = spaced(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        again += line in seen and bool(spaced(line))
        seen.add(line)
    n = len(w)
    return (doc_id, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def test_base_counts_equal_brute_force(spark):
    extra = [(30, "a#b *c\x0b$d\x0c%e\r&f |g <h> é x　y", "en", "s", 0),
             (31, "\n".join(["x y", "", "", "x y ", "x y", " "]), "en", "s", 0),
             (32, "a b c d e " * 3 + prose(40, 3), "en", "s", 0)]
    rows = documents() + extra
    found = L.line_quality(frame(spark, rows), L.Field.neutral()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(tuple, found.collect()), key=str) == sorted((brute(i, t) for i, t, *_ in rows), key=str)


def test_neutral_field_keeps_what_the_base_keeps(spark):
    rows = L.line_quality(frame(spark), L.Field.neutral()).collect()
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert all(r.content_words == r.n_words for r in rows)


def test_fitted_field(spark):
    good = [(i, "\n".join(prose(20, 10 * i + k) + "." for k in range(4)), "en", "s", 0) for i in range(80)]
    bad = [(100 + i, "\n".join(" | ".join(prose(12, 5000 + 10 * i + k).split()) for k in range(4)), "en", "s", 0)
           for i in range(40)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame(
        [(i, 1) for i in range(0, 80, 2)] + [(100 + i, 0) for i in range(0, 40, 2)], "doc_id long, quality int")
    kept = {r.doc_id for r in L.line_quality(docs, L.fit(docs, labels)).collect() if r.kept}
    assert kept == set(range(80))


def test_one_kind_of_labels_is_neutral(spark):
    labels = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    assert L.fit(frame(spark), labels).emit[0, 1] == 1.0
    assert L.line_quality(frame(spark, []), L.Field.neutral()).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_and_gradient(seed):
    rng = np.random.default_rng(seed)
    text = "\n".join(prose(rng.integers(1, 6), int(rng.integers(1e6))) for _ in range(7))
    part = pa.array([None, text, "", "just one line", text[:40]])
    found = L.lines(W.words(part, W.SPACED), W.utf8(part)[0])
    field = L.Field(rng.normal(size=(L.N_FEATURES, 2)), rng.normal(size=(2, 2)),
                    np.zeros(L.N_FEATURES), np.ones(L.N_FEATURES))
    labels = field.viterbi(found.features, found.text)
    for t in np.unique(found.text):
        rows = found.text == t
        score = field.scores(found.features[rows])

        def total(path, score=score):
            return sum(score[i, y] for i, y in enumerate(path)) + sum(
                field.move[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=int(rows.sum())), key=total)
        assert total(labels[rows]) == pytest.approx(total(best))

    x = rng.normal(size=(1, 4, L.N_FEATURES))
    y, sizes = np.array([1]), [1, 1, 1, 1]

    def likelihood(emit):
        f = L.Field(emit, field.move, field.mean, field.scale)
        paths = [sum(x[0, i] @ f.emit[:, p[i]] for i in range(4)) + sum(
            f.move[a, b] for a, b in itertools.pairwise(p)) for p in itertools.product((0, 1), repeat=4)]
        own = sum(x[0, i] @ f.emit[:, 1] for i in range(4)) + 3 * f.move[1, 1]
        return own - np.logaddexp.reduce(paths)

    grad, _ = field._gradient(x, y, np.ones(1), sizes)
    step = np.zeros_like(field.emit)
    step[3, 0] = 1e-5
    slope = (likelihood(field.emit + step) - likelihood(field.emit - step)) / 2e-5
    assert grad[3, 0] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def test_long_documents_train_too(spark):
    """Only texts beyond SAMPLE_LINES are poor: without them there would be one kind of label."""
    n = 3 * L.SAMPLE_LINES
    rows = [(i, "\n".join(prose(12, 100 * i + j) + "." for j in range(5)), "en", "s", 0) for i in range(20)]
    rows += [(20 + i, "\n".join(f"HOME | LOGIN | {j} > NEXT" for j in range(n)), "en", "s", 0) for i in range(10)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(30)], "doc_id long, quality int")
    field = L.fit(frame(spark, rows), labels)
    again = L.fit(frame(spark, rows).repartition(3), labels)
    assert abs(field.emit - again.emit).max() < 1e-9
    shares = {r.doc_id: r.content_share for r in L.line_quality(frame(spark, rows), field).collect()}
    assert all(shares[i] == 1.0 for i in range(20)) and all(shares[i] == 0.0 for i in range(20, 30))
