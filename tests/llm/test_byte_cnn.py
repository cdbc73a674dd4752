import zlib

import numpy as np
import pyarrow as pa
import pytest

from pulsemill.llm import byte_cnn as B
from pulsemill.llm import words as W
from tests.llm.data import frame, prose

SYLLABLES = {"aa": "ba ke lo mi nu", "bb": "sch tz üng ö ver", "cc": "ció ñar dos que la"}


def corpus(per=150):
    return [(i * 3 + k, prose(40, i * 3 + k, s), lang, "s", 0)
            for i in range(per) for k, (lang, s) in enumerate(SYLLABLES.items())]


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = frame(spark, rows)
    truth = {r[0]: r[2] for r in rows}
    found = B.languages(docs, B.fit(docs)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_languages_are_not_learned(spark):
    rows = [(i, t, lang if zlib.crc32(str(i).encode()) % 5 else "secret", s, n) for i, t, lang, s, n in corpus(20)]
    assert B.fit(frame(spark, rows)).languages == sorted(SYLLABLES)


def test_awkward_documents(spark):
    found = B.languages(frame(spark), B.fit(frame(spark))).collect()
    assert len(found) == 20
    assert all((r.lang_pred, r.score) == (B.UNKNOWN, 0.0) for r in found if r.doc_id in (5, 6, 7))
    assert all(r.lang_pred == "en" for r in found if r.doc_id in (1, 8, 13))
    assert B.fit(frame(spark, [])) is None
    assert {r.lang_pred for r in B.languages(frame(spark), None).collect()} == {B.UNKNOWN}
    assert B.languages(frame(spark, []), None).count() == 0


def test_tables_equal_convolution():
    network = B.Network.start(["a", "b"])
    rng = np.random.default_rng(3)
    windows = rng.integers(0, B.SYMBOLS, (5, B.WINDOW)).astype(np.uint8)
    embedded = network.embed[windows]
    pooled = []
    for width, kernel, bias in zip(B.WIDTHS, network.filters, network.bias, strict=True):
        patches = np.stack([embedded[:, j:B.WINDOW - width + 1 + j] for j in range(width)], 2)
        pooled.append(np.maximum((patches.reshape(5, -1, width * B.EMBED) @ kernel).max(1) + bias, 0))
    expected = B._softmax(np.concatenate(pooled, 1) @ network.out + network.out_bias)
    assert np.allclose(network.probabilities(windows), expected, atol=1e-5)


def test_gradient():
    network = B.Network.start(["a", "b"])
    rng = np.random.default_rng(4)
    windows, labels = rng.integers(0, B.SYMBOLS, (6, 30)), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        pooled = []
        for width, kernel, bias in zip(B.WIDTHS, network.filters, network.bias, strict=True):
            e = network.embed[windows]
            patches = np.concatenate([e[:, j:31 - width + j] for j in range(width)], 2)
            pooled.append(np.maximum((patches @ kernel).max(1) + bias, 0))
        p = B._softmax(np.concatenate(pooled, 1) @ network.out + network.out_bias)
        return -np.log(p[np.arange(6), labels]).mean()

    for p, g in zip(network._parameters(), network._gradients(windows, labels), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep = p[at]
        p[at] = keep + 1e-5
        up = loss()
        p[at] = keep - 1e-5
        assert abs((up - loss()) / 2e-5 - g[at]) < 1e-3 * max(1, abs(g[at]))
        p[at] = keep


def test_windows_hold_all_bytes():
    texts = pa.array(["x" * 500, None, "", "y" * B.WINDOW])
    windows, text = B.windows_of(*W.utf8(texts))
    assert text.tolist() == [0, 0, 0, 3] and (windows > 0).sum() == 500 + B.WINDOW


def test_scores_against_plain_convolution(spark):
    """Every document's language and score, window by window and filter by filter."""
    network = B.Network.start(["aa", "bb", "cc"], seed=5)
    rows = [(i, t, None, "s", 0) for i, t in enumerate(
        ["short", "é" * 150, prose(90, 3), prose(400, 4) + " Ωμέγα", "x", prose(31, 5)[:B.WINDOW], "1 2 3 z"])]

    def window_odds(symbols):
        seen = network.embed[symbols]
        hidden = []
        for width, kernel, bias in zip(B.WIDTHS, network.filters, network.bias):
            answers = [seen[at:at + width].ravel() @ kernel for at in range(B.WINDOW - width + 1)]
            hidden.extend(np.maximum(np.max(answers, axis=0) + bias, 0))
        odds = np.exp(np.array(hidden) @ network.out + network.out_bias)
        return odds / odds.sum()

    result = {r.doc_id: (r.lang_pred, r.score) for r in B.languages(frame(spark, rows), network).collect()}
    for i, text, *_ in rows:
        symbols = [int(B.SYMBOL_OF[b]) for b in text.encode()]
        symbols += [0] * (-len(symbols) % B.WINDOW)
        parts = [window_odds(symbols[at:at + B.WINDOW]) for at in range(0, len(symbols), B.WINDOW)]
        mean = np.mean(parts, axis=0)
        assert result[i][0] == network.languages[int(mean.argmax())]
        assert result[i][1] == pytest.approx(mean.max(), abs=1e-4)
