"""Token alignment against whole-text encoding and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pulsemill.llm import cross_tokens as X
from pulsemill.llm import token_runs as R
from tests.llm.data import DOCS, documents, frame, prose

KNOWN = X.Aligner(X.FOLDER)

ODD = [
    " leading", "trailing ", "two  spaces", "tab\tand\nnewline \n here", "a b  c", "▁piece ▁", "<|endoftext|> <s> <unk> <0x0A>",
    "x" * 3000, "日本語のテキスト と 空白", "emoji 🙂🙂🏽 ‍", "it's we'll I'M don't", "1234567 12,5 +1 (555)", " ", "\n", "\x00nul\x1f \x1c y",
    "a b" * 50, "é" * 40 + " " + "﻿bom", "   ", "CaSe   MiX  \r\n  z", "́ combining", "word " * 30,
]


def whole(text):
    """Token ids and bytes of a whole text by both tokenizers, None if it isn't given back."""
    known = KNOWN
    a = known.first.encode(" " + text, add_special_tokens=False).ids
    b = known.second.encode(text)
    x, y = [known.first_bytes[i] for i in a], [known.second_bytes[i] for i in b]
    want = (" " + text).encode()
    return (a, x, b, y) if b"".join(x) == want == b"".join(y) else None


def groups_of(text):
    found = whole(text) if text else None
    if not found:
        return []
    a, x, b, y = found
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    both = sorted(set(ends(x)) & set(ends(y)))
    out, i, j, ea, eb = [], 0, 0, ends(x), ends(y)
    for end in both:
        k, m = ea.index(end, i) + 1, eb.index(end, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def by_hand(rows):
    docs = [(i, groups_of(t)) for i, t in rows]
    links = [Counter((p, q) for x, y in g for p in x for q in y) for _, g in docs]
    count = Counter(pair for c in links for pair in c)
    highest = {}
    for (p, _), n in count.items():
        highest[p] = max(highest.get(p, 0), n)
    out = []
    for (i, g), c in zip(docs, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
            sum(n for pair, n in c.items() if count[pair] == highest[pair[0]]),
            sum(n * count[pair] for pair, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["one slice", "many slices"])
def sizes(request, monkeypatch):
    if request.param == "many slices":
        monkeypatch.setattr(X, "SLICE_BYTES", 300)
        monkeypatch.setattr(X, "FAN_IN", 3)
        monkeypatch.setattr(X, "RADIX", 7)
        monkeypatch.setattr(X, "CHUNK_CHARS", 40)
        monkeypatch.setattr(X, "BIG_GROUP", 3)


def test_equals_plain_counting(spark, sizes):
    docs = frame(spark).unionByName(frame(spark, [(100 + i, t, None, None, 0) for i, t in enumerate(ODD)]))
    assert got(X.aligned(docs)) == by_hand(rows_of(docs))


def test_one_token_in_all_documents(spark, sizes):
    docs = spark.createDataFrame([(i, "the" if i % 3 else "the end", None, None, 0) for i in range(400)], DOCS)
    assert got(X.aligned(docs)) == by_hand(rows_of(docs))


def test_empty_table(spark):
    assert X.aligned(frame(spark, [])).count() == 0


def test_segments_join_to_whole_texts():
    """Random mixes of spaces, white space and characters: cut segments encode as the whole does."""
    rng = random.Random(3)
    known = X.Aligner(X.FOLDER)
    alphabet = list("  ab'.,1é\n\t  \x1c▁日🙂́") + ["the", "ing", "  ", "'s", "12"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 25)))
        sums, digests, _ = X._slice_rows([text], known)
        g = groups_of(text)
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        assert digests[0] == (hashlib.sha256(want.encode()).hexdigest() if g else ""), repr(text)


def test_the_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr(X, "REMEMBERED", 50)
    known = X.Aligner(X.FOLDER)
    for seed in range(8):
        X._slice_rows([prose(60, seed), "y" * 100], known)
        assert len(known.known) <= 50 + 61


def test_runs_round_trip_and_merge(monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 16)
    rng = np.random.default_rng(1)
    runs, total = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 1 << 36, rng.integers(0, 200)) >> 29 << 28)
        counts = rng.integers(1, 1 << 40, len(pairs))
        total.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append(R.run_of(pairs, counts))
        assert [x.tolist() for x in R.read(runs[-1])] in ([], [pairs.tolist(), counts.tolist()])
    parts = list(R.with_maxima(R.merged(runs, emit=32)))
    pairs, counts, highest = (np.concatenate(x).tolist() for x in zip(*parts, strict=True))
    assert pairs == sorted(total) and dict(zip(pairs, counts, strict=True)) == total
    best = {}
    for p, n in total.items():
        best[p >> 32] = max(best.get(p >> 32, 0), n)
    assert highest == [total[p] == best[p >> 32] for p in pairs]


def test_awkward_documents_are_all_there(spark):
    assert X.aligned(frame(spark)).count() == len(documents())
